"""Snapshot archive scan and raw file sources."""

import hashlib
import json
import math
import os
import tempfile

import pytest
from pyspark.sql import functions as F


def _write_snapshot(spark, folder, states, time=120, corrupt=False):
    from skylens.sources.snapshots import with_snapshot_key
    box = {"lamax": 24.0, "lamin": 8.0, "lomax": 110.0, "lomin": 102.0}
    response = {"states": states, "time": time}
    text = json.dumps({"bounding_box": box, "response": response})
    digest = with_snapshot_key(spark.createDataFrame([(text,)], "value string")).first().source_sha256
    doc = {"schema_version": 1, "source_sha256": digest, "collected_at": 125.0, "bounding_box": box,
           "response": {**response, "time": time + 1} if corrupt else response}
    with open(os.path.join(folder, digest + ".json"), "w") as out:
        json.dump(doc, out)
    return digest


ROW = ["abc123", " ABC ", "Vietnam", 100, 110, 105.5, 20.25, 10000.5, False, 100.5, 90.5, 0.5, None, None, None, False, 0]


def test_snapshot_scan(spark):
    from skylens.sources.snapshots import corrupted, empty_snapshots, read_snapshots, state_events, verified
    folder = tempfile.mkdtemp(prefix="skylens-snap-")
    _write_snapshot(spark, folder, [ROW, ROW])
    _write_snapshot(spark, folder, [], time=600)
    _write_snapshot(spark, folder, [ROW], time=240, corrupt=True)
    snaps = read_snapshots(spark, folder)
    assert verified(snaps).count() == 2 and corrupted(snaps).count() == 1
    assert empty_snapshots(verified(snaps)).count() == 1
    events = state_events(verified(snaps)).collect()
    assert len(events) == 2 and all(e.row_error is None for e in events)
    assert events[0].state.icao24 == "abc123" and events[0].state.latitude == 20.25


def test_raw_profile_and_replay(spark):
    from skylens.sources.raw_files import catalog, profile, replay_receptions
    raw = spark.createDataFrame([("8D40621D58C382D690C8AC2863A7", 103.0, 1), ("8D40621D58C386435CC412692AD6", 100.0, 2),
                                 ("8D40621D58C386435CC412692AD6", float("nan"), 3)],
                                "rawMessage string, timeAtServer double, sensorSerialNumber int")
    p = profile(raw).first()
    assert (p.record_count, p.event_time_min, p.event_time_max) == (3, 100.0, 103.0)
    with pytest.raises(ValueError):
        profile(raw.drop("rawMessage"))
    rows = replay_receptions(raw, checksum="c", run_id="r", source_url="u", start=1, max_rows=5).collect()
    assert sorted(r.envelope.record_index for r in rows) == [1, 2]
    nan_row = [r for r in rows if r.envelope.record_index == 2][0]
    assert nan_row.envelope.event_time is None
    assert nan_row.envelope.reception_id == hashlib.sha256(b"c:2").hexdigest()
    files = spark.createDataFrame([("a.avro", 10), ("b.avro", 0), ("c.txt", 5), ("d.avro", 7)], "url string, size long")
    done = catalog(files, spark.createDataFrame([], "identity string")).limit(1).select("identity")
    left = catalog(files, done)
    assert left.count() == 1


def test_archived_documents_are_verified_one_by_one(spark):
    from skylens.sources.events import snapshot_objects, table
    from skylens.sources.snapshots import archived_rows, snapshot_documents
    objects = snapshot_objects(table(spark, "/root/testdata/sf0.001", "events")).collect()
    bodies = [json.loads(o.value) for o in objects]
    assert all(o.path == f"snapshots/{b['source_sha256']}.json" for o, b in zip(objects, bodies))
    assert len({o.path for o in objects}) == len(objects) and {b["bounding_box"]["lamin"] for b in bodies} == {8.0, 11.0}

    def read(pairs):
        rows = archived_rows(snapshot_documents(spark.createDataFrame(pairs, "path string, value string")))
        return {path: (intact, n, bad) for path, intact, n, bad in rows.groupBy("path").agg(
            F.bool_and("intact"), F.count("source_row_text"), F.count("row_error")).collect()}

    seen = read([(o.path, o.value) for o in objects])
    for o, b in zip(objects, bodies):
        assert seen[o.path] == ("altered" not in b["response"], len(b["response"]["states"] or []), 0)
    assert {len(b["response"]["states"] or []) for b in bodies} >= {0, 1, 2} and any(b["response"]["states"] is None for b in bodies)
    # another box, a lost row, a foreign name, a text that is no document, and a row that is no state vector
    sound = next(o for o, b in zip(objects, bodies) if b["response"]["states"] and "altered" not in b["response"])
    body = json.loads(sound.value)
    moved = json.dumps(body | {"bounding_box": body["bounding_box"] | {"lamin": 7.5}})
    emptied = json.dumps(body | {"response": body["response"] | {"states": []}})
    short = json.dumps(body | {"response": body["response"] | {"states": [["abc"]]}})
    got = read([("a/" + sound.path, sound.value), ("b/" + sound.path, moved), ("c/" + sound.path, emptied), ("d/" + "0" * 64 + ".json", sound.value),
                ("e/" + sound.path, "{broken"), ("f/" + sound.path, short)])
    n = len(body["response"]["states"])
    assert [got[k] for k in sorted(got)] == [(True, n, 0), (False, n, 0), (False, 0, 0), (False, n, 0), (False, 0, 0), (False, 1, 1)]
