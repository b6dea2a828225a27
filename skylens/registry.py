"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the given tables.

Column names and rounding match ``skylens.oracle`` one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.operators.cells import aircraft_windows
from skylens.operators.density import density_statistics
from skylens.operators.movement import movement_segments, observation_gaps
from skylens.operators.normalize import normalize_observations
from skylens.operators.quality import quality_counts, quality_enriched, quality_long, quality_wide
from skylens.operators.serving import movement_pages, overview_summary, overview_windows
from skylens.sources.events import state_rows, table

Query = Callable[[SparkSession, str], DataFrame]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver observations derived from the ``events`` table."""
    return normalize_observations(state_rows(table(spark, sf_dir, "events")))


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as a stored table, which operators that read it twice (histogram, then rows) expect."""
    from skylens.session import written
    return written(silver(spark, sf_dir), "silver")


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aircraft_windows(silver(spark, sf_dir))


def _movement(spark, sf_dir):
    return movement_segments(stored_silver(spark, sf_dir))


def _round_movement(df: DataFrame) -> DataFrame:
    return (df.withColumn("distance_m", F.round("distance_m", 3))
              .withColumn("observed_speed_mps", F.round("observed_speed_mps", 6)))


def q_normalize_flags(spark, sf_dir):
    return (silver(spark, sf_dir)
            .drop("event_time_basis", "schema_version", "source_object")
            .withColumn("quality_flags", F.array_join("quality_flags", ",")))


def q_flag_histogram(spark, sf_dir):
    return (silver(spark, sf_dir).select(F.explode("quality_flags").alias("flag"))
            .groupBy("flag").agg(F.count(F.lit(1)).alias("observations")))


def q_movement_segments(spark, sf_dir):
    return _round_movement(_movement(spark, sf_dir))


def q_observation_gaps(spark, sf_dir):
    return _round_movement(observation_gaps(_movement(spark, sf_dir)))


def q_cell_windows(spark, sf_dir):
    return gold(spark, sf_dir)


def q_density_stats(spark, sf_dir):
    out = density_statistics(gold(spark, sf_dir))
    for c in ("baseline_mean", "baseline_stddev", "density_zscore"):
        out = out.withColumn(c, F.round(c, 6))
    return out


def q_quality_counts(spark, sf_dir):
    return quality_enriched(quality_counts(silver(spark, sf_dir)))


def q_quality_wide(spark, sf_dir):
    return quality_wide(quality_counts(silver(spark, sf_dir)))


def q_quality_long(spark, sf_dir):
    return quality_long(quality_wide(quality_counts(silver(spark, sf_dir))))


def q_overview_windows(spark, sf_dir):
    return overview_windows(silver(spark, sf_dir), hours=None)


def q_overview_recent(spark, sf_dir):
    """AG-12 with a cutoff that leaves rows out: the last six hours of the table."""
    return overview_windows(silver(spark, sf_dir), hours=6)


def q_reception_invariants(spark, sf_dir):
    """FLT-9 / AG-1: the four counts over receptions with defects by record_index."""
    from skylens.operators.receptions import delivered, invariant_counts
    from skylens.sources.events import raw_receptions
    rows = delivered(raw_receptions(table(spark, sf_dir, "events")))
    i = F.col("record_index")
    broken = rows.withColumns({
        "reception_id": F.when(i % 97 == 0, F.lit(None)).when(i % 83 == 0, F.lit("renamed")).otherwise(F.col("reception_id")),
        "receiver_id": F.when(i % 89 == 0, F.lit(None)).otherwise(F.col("receiver_id"))})
    again = rows.where(i % 79 == 0).withColumn("source_record_json", F.lit("{}"))
    return invariant_counts(broken.unionByName(again))


def q_pending_outbox(spark, sf_dir):
    """SNK-11 / JN-10: snapshots without a receipt for the topic; every third was delivered."""
    from skylens.plans.publish import pending, receipts_for
    rows = state_rows(table(spark, sf_dir, "events")).select(F.col("snapshot_id").alias("snapshot_key"), "snapshot_time")
    delivered = rows.where(F.col("snapshot_time") % 30 == 0)
    receipts = receipts_for(delivered, delivered, "states").unionByName(receipts_for(rows, rows.limit(0), "other"))
    return pending(rows.select("snapshot_key").distinct(), receipts, topic="states")


def q_raw_envelope_status(spark, sf_dir):
    """PRJ-1: status of raw deliveries, with defects by record_index."""
    from skylens.operators.envelope import archive_rows, raw_kafka_rows
    from skylens.sources.events import raw_receptions
    kafka = raw_kafka_rows(raw_receptions(table(spark, sf_dir, "events")))
    text, i = F.col("value").cast("string"), F.col("offset")
    value = (F.when(i % 97 == 0, F.lit("{broken")).when(i % 89 == 0, F.regexp_replace(text, '"schema_version":1', '"schema_version":2'))
             .when(i % 83 == 0, F.regexp_replace(text, '"raw_reception"', '"other"')).otherwise(text))
    rows = archive_rows(kafka.withColumn("value", value.cast("binary")))
    return rows.select("partition", "offset", F.col("envelope_status").alias("status"),
                       F.when(F.col("envelope_status") != "malformed_json", F.col("envelope.reception_id")).alias("reception_id"))


def q_attribute_states(spark, sf_dir):
    """PIPE-4: the attributes carried to each decoded position, with their age."""
    from skylens.operators.receptions import derived
    from skylens.operators.reconstruct import reconstruct, states
    positions, _ = reconstruct(_written_transmissions(spark, sf_dir), derived=derived())
    return (states(positions)
            .select("reception_id", "callsign", "callsign_status", "callsign_updated_at", "speed_knots", "speed_knots_status", "speed_knots_updated_at",
                    "vertical_rate_fpm", "vertical_rate_fpm_status"))


def q_overview_summary(spark, sf_dir):
    out = overview_summary(overview_windows(silver(spark, sf_dir), hours=None))
    return (out.withColumn("position_share", F.round("position_share", 6))
               .withColumn("stale_share", F.round("stale_share", 6)))


def q_movement_pages(spark, sf_dir):
    from skylens.session import written
    return _round_movement(movement_pages(written(_movement(spark, sf_dir), "movement"), page_size=200))


def _dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table dealt out over the tasks before wide rows are made of it (it may be a single file)."""
    from skylens.session import in_parts
    return table(in_parts(spark), sf_dir, "events").repartition("event_id")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze (PRJ-2) of the Kafka-shaped state deliveries derived from ``events``.

    The generated deliveries are a written table, so validation reads stored messages from many files,
    as it does from Kafka or a Bronze table.
    """
    from skylens.operators.envelope import archive_frame
    from skylens.session import written
    from skylens.sources.events import state_deliveries
    return archive_frame(written(state_deliveries(_dealt(spark, sf_dir)), "deliveries"))


def q_state_envelopes(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "partition", "offset", F.col("parsed.error").alias("error"),
        F.col("parsed.observation.icao24").alias("icao24"),
        F.col("parsed.observation.snapshot_time").alias("snapshot_time"),
        F.col("parsed.observation.latitude").alias("latitude"),
        F.array_join("parsed.observation.quality_flags", ",").alias("quality_flags"))


def q_first_delivery(spark, sf_dir):
    from skylens.operators.envelope import bronze_observations
    from skylens.plans.lake import first_delivery
    firsts = first_delivery(bronze(spark, sf_dir).where(F.col("parsed.error").isNull())
                            .select("topic", "partition", "offset", "parsed.observation.*"))
    return firsts.select("partition", "offset", "icao24", "snapshot_time", "time_position")


def _classified(spark, sf_dir):
    from skylens.operators.receptions import receptions
    from skylens.sources.events import raw_receptions
    from skylens.session import written
    return receptions(written(raw_receptions(_dealt(spark, sf_dir)), "raw"))[1]


def q_frame_decode(spark, sf_dir):
    return _classified(spark, sf_dir).select(
        "reception_id", "record_index", "receiver_id", "status", "reason", "icao24", "category", "parity",
        "altitude_ft", "callsign", "speed_knots", "track_deg", "vertical_rate_fpm")


# Of a reception, what it was decoded from and where it came from: nothing that is made of transmissions reads it.
PROVENANCE = ("schema_version", "record_type", "mode", "dataset_id", "source_url", "source_reception_time", "event_time_basis",
              "source_record_json", "source_payload_sha256", "status", "reason")


def _members(spark, sf_dir):
    from skylens.operators.receptions import members
    return members(_classified(spark, sf_dir).where(F.col("status") == "valid"), checked=True)


def _written_transmissions(spark, sf_dir):
    """Transmissions as a stored table, as pairing reads them in a batch run."""
    from skylens.operators.receptions import compact, identified, representatives
    from skylens.session import written
    return identified(written(compact(representatives(_members(spark, sf_dir))).drop(*PROVENANCE), "transmissions"))


def q_transmission_lineage(spark, sf_dir):
    return _members(spark, sf_dir).select("reception_id", "ambiguous", F.col("leads").alias("representative"), "members")


def q_cpr_positions(spark, sf_dir):
    from skylens.operators.receptions import derived
    from skylens.operators.reconstruct import reconstruct
    _, quality = reconstruct(_written_transmissions(spark, sf_dir), derived=derived())
    return (quality
            .select("reception_id", "icao24", "event_time", "partner_reception", "outcome", "latitude", "longitude"))


def q_archive_report(spark, sf_dir):
    from skylens.operators.reports import archive_report
    events = table(spark, sf_dir, "events")
    rows = state_rows(events)
    copies = rows.unionByName(state_rows(events.where(F.col("event_id") % 5 == 0)))
    from skylens.plans.lake import deduplicated
    observations = normalize_observations(deduplicated(copies))
    return archive_report(copies, observations)


def q_archive_documents(spark, sf_dir):
    """SRC-8 / EXP-1 / SNK-13 / PIPE-8: documents written under their digest and read back, with the rows that each
    holds and, of intact ones, its observations and those inside its own box."""
    from skylens.operators.cells import in_box
    from skylens.plans.archive import bounds, snapshot_observations
    from skylens.session import written
    from skylens.sources.events import snapshot_objects
    from skylens.sources.snapshots import archived_rows, snapshot_documents
    objects = written(snapshot_objects(table(spark, sf_dir, "events")), "archive")
    rows = written(archived_rows(snapshot_documents(objects)), "archived")
    documents = rows.groupBy("lamin", "snapshot_time", "intact").agg(F.count("source_row_text").alias("state_rows"), F.count("row_error").alias("malformed"))
    _, observations, scopes = snapshot_observations(rows.where("intact"))
    seen = (observations.join(scopes, "scope_id").groupBy("lamin", "snapshot_time")
            .agg(F.count(F.lit(1)).alias("observations"), F.count_if(in_box(bounds())).alias("inside"), F.min("scope_id").alias("scope_id")))
    return documents.join(seen, ["lamin", "snapshot_time"], "left").select(
        "lamin", "snapshot_time", "intact", "state_rows", "malformed", "scope_id",
        F.coalesce("observations", F.lit(0)).cast("long").alias("observations"), F.coalesce("inside", F.lit(0)).cast("long").alias("inside"))


def q_snapshot_gaps(spark, sf_dir):
    from skylens.operators.reports import snapshot_gaps
    return snapshot_gaps(silver(spark, sf_dir), expected_interval=120)


def q_stream_windows(spark, sf_dir):
    """STR-1..4: the three-stage streaming chain (availableNow) over the events deliveries; Gold read back.

    Work folders live under the session's checkpoint directory (the shared folder on a cluster).
    """
    import uuid
    from skylens.session import checkpoint_dir
    from skylens.sources.events import state_deliveries
    from skylens.streaming.states import run_chain, stream_files
    root = f"{checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    source = stream_files(spark, state_deliveries(_dealt(spark, sf_dir)), root + "/incoming")
    run_chain(spark, root + "/lake", source)
    return spark.read.parquet(root + "/lake/gold")


_RESUMED: dict[tuple[str, str], str] = {}


def _resumed(spark: SparkSession, sf_dir: str) -> str:
    """SRC-1 / STR-4..6: folder of a chain that ran three times, each time stopped and resumed from its
    checkpoints after a third of the time span had arrived (every 101st event a third later, so mostly
    behind the watermark), with two files a batch at most. Once a session."""
    import uuid
    from skylens.session import checkpoint_dir, in_parts
    from skylens.sources.events import state_deliveries
    from skylens.streaming.states import run_chain, stream_files
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RESUMED:
        root = f"{checkpoint_dir(spark).rstrip('/')}/resumed-{uuid.uuid4().hex}"
        arrival = arriving(table(in_parts(spark), sf_dir, "events"))
        for n in range(3):
            source = stream_files(spark, state_deliveries(arrival(n)).repartition(4), root + "/incoming", max_files=2)
            run_chain(spark, root + "/lake", source)
        _RESUMED[key] = root + "/lake"
    return _RESUMED[key]


def q_stream_resumed(spark, sf_dir):
    return spark.read.parquet(_resumed(spark, sf_dir) + "/gold")


def q_stream_progress(spark, sf_dir):
    """STR-11: rows that each stage took in and dropped as late, from the progress of all its batches."""
    from skylens.streaming.progress import batches
    log = batches(spark, _resumed(spark, sf_dir) + "/progress")
    return log.groupBy("stage").agg(F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows"), F.count_distinct("run_id").alias("runs"))


def q_position_lineage(spark, sf_dir):
    """JN-2 / JN-3 / SET-6: every position with the receptions that it rests on."""
    from skylens.plans.preprocess import preprocess
    from skylens.session import written
    from skylens.sources.events import raw_receptions
    raw = written(raw_receptions(_dealt(spark, sf_dir)), "raw")
    # the one table that is read twice here
    made = preprocess(raw, lambda name, frame: written(frame.drop(*PROVENANCE), name) if name == "members" else frame)
    return _sourced(made["positions"])


def _sourced(positions: DataFrame) -> DataFrame:
    return (positions
            .select("reception_id", "icao24", "event_time", "latitude", "longitude", F.size("source_reception_ids").alias("n_sources"),
                    F.array_join("source_reception_ids", ",").alias("sources")))


def arriving(events: DataFrame) -> Callable[[int], DataFrame]:
    """The events of arrival 0, 1 or 2: the third of the table's time span that an event lies in; every 101st
    event comes one arrival later. An arrival is chosen before wide rows are made of its events, and dealt out
    over as many tasks as a shuffle has: by their own bytes, which are few, they would be merged into one or some."""
    from skylens.sources.events import epoch_seconds_ntz
    t = epoch_seconds_ntz("ts")
    low, high = events.agg(F.min(t), F.max(t)).first()
    low, high = (0, 0) if low is None else (low, high)
    third = F.floor((t - low) * 3 / (high - low + 1)).cast("int")
    arrival = third + F.when((third < 2) & (F.col("event_id") % 101 == 0), 1).otherwise(0)
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lambda n: events.where(arrival == n).repartition(tasks, "event_id")


def raw_archive(events: DataFrame) -> DataFrame:
    """Raw Kafka rows of ``events``, archived."""
    from skylens.operators.envelope import archive_rows, raw_kafka_rows
    from skylens.sources.events import raw_receptions
    return archive_rows(raw_kafka_rows(raw_receptions(events)))


_EPOCHS: dict[tuple[str, str], str] = {}


def _epochs(spark: SparkSession, sf_dir: str) -> str:
    """STR-6..9: folder of the epochs that three arrivals made, each a run of one stream resumed from its
    checkpoint by a new process's sink; the last completes the declared number of deliveries. Once a session.

    The files of an arrival stand for a topic that retains what wasn't read: they go once their epochs are published."""
    import uuid
    from skylens.plans import fs
    from skylens.session import checkpoint_dir, in_parts
    from skylens.sources.events import raw_receptions
    from skylens.streaming.epochs import StreamingEpochs, start_epochs
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _EPOCHS:
        root = f"{checkpoint_dir(spark).rstrip('/')}/epochs-{uuid.uuid4().hex}"
        events = table(in_parts(spark), sf_dir, "events")
        arrival, total = arriving(events), raw_receptions(events).count()
        for n in range(3):
            rows = raw_archive(arrival(n))
            rows.write.mode("append").option("compression", "zstd").parquet(root + "/incoming")
            source = spark.readStream.schema(rows.schema).parquet(root + "/incoming")
            start_epochs(source, StreamingEpochs(spark, root + "/out", "events", expected=total), root + "/checkpoint").awaitTermination()
            fs.delete(spark, root + "/incoming")
        _EPOCHS[key] = root + "/out"
    return _EPOCHS[key]


def q_epoch_positions(spark, sf_dir):
    from skylens.streaming.epochs import epoch_union
    return _sourced(epoch_union(spark, _epochs(spark, sf_dir), "positions"))


def q_epoch_late(spark, sf_dir):
    from skylens.streaming.epochs import epoch_union
    return epoch_union(spark, _epochs(spark, sf_dir), "late_deliveries").select("partition", "offset", F.col("envelope.event_time").alias("event_time"))


def queries() -> dict[str, Query]:
    return {
        "normalize_flags": q_normalize_flags,
        "flag_histogram": q_flag_histogram,
        "movement_segments": q_movement_segments,
        "observation_gaps": q_observation_gaps,
        "cell_windows": q_cell_windows,
        "density_stats": q_density_stats,
        "quality_counts": q_quality_counts,
        "quality_wide": q_quality_wide,
        "quality_long": q_quality_long,
        "overview_windows": q_overview_windows,
        "overview_recent": q_overview_recent,
        "overview_summary": q_overview_summary,
        "reception_invariants": q_reception_invariants,
        "pending_outbox": q_pending_outbox,
        "raw_envelope_status": q_raw_envelope_status,
        "attribute_states": q_attribute_states,
        "movement_pages": q_movement_pages,
        "state_envelopes": q_state_envelopes,
        "first_delivery": q_first_delivery,
        "frame_decode": q_frame_decode,
        "transmission_lineage": q_transmission_lineage,
        "cpr_positions": q_cpr_positions,
        "position_lineage": q_position_lineage,
        "epoch_positions": q_epoch_positions,
        "epoch_late": q_epoch_late,
        "archive_report": q_archive_report,
        "archive_documents": q_archive_documents,
        "snapshot_gaps": q_snapshot_gaps,
        "stream_windows": q_stream_windows,
        "stream_resumed": q_stream_resumed,
        "stream_progress": q_stream_progress,
    }
