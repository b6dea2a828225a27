"""Plans that keep validation, decoding and streams in proportion to their input."""

import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_generators_only_pass_on_what_projections_compute(spark):
    """Compiled projections do the work; a generator or a lambda outside a compiled stage is evaluated node by node."""
    from skylens.operators.envelope import archive_frame
    from skylens.operators.frames import decode_frames
    from skylens.operators.receptions import delivered
    from skylens.sources.events import raw_receptions, state_deliveries, table
    from skylens.session import written
    events = table(spark, SF, "events")
    for frame in (archive_frame(written(state_deliveries(events), "deliveries")).select("parsed"),
                  decode_frames(delivered(written(raw_receptions(events), "raw")))):
        generators = re.findall(r"Generate inline\((.*)", frame._jdf.queryExecution().optimizedPlan().toString())
        assert generators and not any("CASE WHEN" in g.split(", false, [")[0] for g in generators)
        assert "lambdafunction" not in frame._jdf.queryExecution().optimizedPlan().toString()


def test_flags_are_sorted_and_hold_no_nulls(spark):
    from skylens.functions.columns import flag_array
    rows = spark.createDataFrame([(True, True), (False, None)], "a boolean, b boolean")
    assert [r[0] for r in rows.select(flag_array((F.col("a"), "z"), (F.col("b"), "b"))).collect()] == [["b", "z"], []]


def test_a_missing_state_key_is_not_a_null(spark):
    from skylens.operators.envelope import archive_frame, state_envelope_value
    from skylens.sources.events import state_rows, table
    rows = state_rows(table(spark, SF, "events").where("event_id = 1"))
    good = rows.select(state_envelope_value(rows).alias("v")).first().v
    assert '"sensors":null' in good
    for value, error in ((good, None), (good.replace('"sensors":null', '"other":null'), "envelope_mismatch"), (good.replace('"sensors":null,', ""), "envelope_mismatch")):
        kafka = spark.createDataFrame([("states", 0, 0, None, bytearray(value.encode()))], "topic string, partition int, offset long, timestamp timestamp, value binary")
        assert archive_frame(kafka).select("parsed.error").first()[0] == error


def test_wide_rows_are_made_after_events_are_dealt_out(spark):
    """No shuffle of generated deliveries, and only the decoded columns move with a reception."""
    from skylens import registry
    from skylens.operators.receptions import receptions
    from skylens.sources.events import raw_receptions, table
    registry.bronze(spark, SF)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8000
    classified = receptions(raw_receptions(table(spark, SF, "events")))[1].select("reception_id", "status", "reason")
    assert "source_payload_sha256" not in plan(classified) and "WindowGroupLimit" in plan(classified)


def test_an_arrival_is_chosen_among_the_events(spark):
    """Each event comes in one arrival, without a join of the wide rows made of it."""
    from skylens import registry
    from skylens.sources.events import table
    events = table(spark, SF, "events")
    arrival = registry.arriving(events)
    parts = [arrival(n) for n in range(3)]
    assert all(p.count() for p in parts) and sorted(r[0] for p in parts for r in p.select("event_id").collect()) == sorted(r[0] for r in events.select("event_id").collect())
    assert "Join" not in plan(registry.raw_archive(parts[0]))


def test_a_batch_is_not_copied_before_its_epoch(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame
    from skylens import registry
    from skylens.sources.events import table
    from skylens.streaming.epochs import StreamingEpochs
    monkeypatch.setattr(DataFrame, "persist", lambda *_: (_ for _ in ()).throw(AssertionError("copied")))
    StreamingEpochs(spark, str(tmp_path / "out"), "events")(registry.raw_archive(table(spark, SF, "events").where("event_id < 40")), 0)


def test_a_few_large_files_are_many_row_groups(spark, tmp_path, monkeypatch):
    import pyarrow.parquet as pq
    from skylens.sources.events import state_deliveries, table
    from skylens.streaming import states
    monkeypatch.setattr(states, "ROW_GROUP", 100_000)
    states.stream_files(spark, state_deliveries(table(spark, SF, "events")).coalesce(1), str(tmp_path))
    assert all(pq.ParquetFile(f).num_row_groups > 1 for f in tmp_path.glob("*.parquet"))


def test_lineage_and_pairing_join_nothing(spark):
    """A transmission's receptions and its partner's go with the frame; ids that follow from other columns aren't moved."""
    from skylens import registry
    for name in ("position_lineage", "cpr_positions", "attribute_states", "transmission_lineage"):
        frame = registry.queries()[name](spark, SF)
        assert "Join" not in plan(frame) and frame.count(), name
    # the shuffle of a track's frames moves no id
    moved = plan(registry.q_cpr_positions(spark, SF)).split("Exchange hashpartitioning(source_sha256")[1]
    assert "transmission_id" not in moved and "reception_id" not in moved


def test_checked_receptions_are_grouped_like_any(spark):
    from skylens.operators.receptions import compact, heard_ids, identified, lineage_members, lineage_of, members, receptions
    from skylens.sources.events import raw_receptions, table
    valid = receptions(raw_receptions(table(spark, SF, "events")))[1].where("status = 'valid'")
    plain, checked = members(valid), members(valid, checked=True)
    same = ["reception_id", "transmission_id", "message", "ambiguous", "leads", "members"]
    assert plain.count() and plain.select(same).exceptAll(checked.select(same)).isEmpty() and checked.select(same).exceptAll(plain.select(same)).isEmpty()
    assert identified(compact(checked)).select(same).exceptAll(checked.select(same)).isEmpty()
    want = {r.transmission_id: r.target_receptions for r in lineage_members(lineage_of(plain)).collect()}
    leading = checked.where("leads").select("transmission_id", heard_ids("heard").alias("ids")).collect()
    assert {r.transmission_id: r.ids for r in leading} == want and len(leading) == len(want) and max(map(len, want.values())) > 1


def test_a_bin_with_a_repeated_receiver_is_not_listed(spark):
    from skylens.operators.receptions import members
    rows = spark.range(300).selectExpr("'s' as source_sha256", "concat('r', id) as reception_id", "'8D' as raw_message", "cast(id % 299 as int) as receiver_id", "10.001D as event_time")
    got = members(rows).collect()
    assert len(got) == 300 and all(r.ambiguous and r.leads and r.members == 1 and r.heard == [r.reception_id] for r in got)
    once = members(rows.where("receiver_id > 0")).collect()
    assert [(r.reception_id, len(r.heard)) for r in once if r.leads] == [("r1", 298)] and {r.members for r in once} == {298}
