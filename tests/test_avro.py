"""Avro containers: reading whole and split, and import with hashes, manifest and counters."""

import hashlib
import json
import random
import struct
import zlib

import pytest

from skylens.sources.raw_files import avro_receptions, import_files

SCHEMA = {"type": "record", "name": "Heard", "fields": [
    {"name": "rawMessage", "type": ["null", "string"]}, {"name": "timeAtServer", "type": "double"}, {"name": "sensorSerialNumber", "type": "int"},
    {"name": "sensorType", "type": {"type": "enum", "name": "Kind", "symbols": ["a", "b"]}}, {"name": "tags", "type": {"type": "array", "items": "long"}},
    {"name": "extra", "type": {"type": "map", "values": "boolean"}}]}


def number(n):
    n = n << 1 if n >= 0 else (-n << 1) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def blob(data):
    return number(len(data)) + data


def record(i, time):
    message = number(0) if i % 7 == 0 else number(1) + blob(b"8D%026X" % i)
    return (message + struct.pack("<d", time) + number(i % 5 - 2) + number(i % 2) + (number(2) + number(i) + number(-i) if i % 3 else b"") + number(0)
            + number(1) + blob(b"k") + bytes([i % 2]) + number(0))


def container(times, codec="null", per_block=10, seed=0, schema=SCHEMA):
    sync = random.Random(seed).randbytes(16)
    out = b"Obj\x01" + number(2) + blob(b"avro.schema") + blob(json.dumps(schema).encode()) + blob(b"avro.codec") + blob(codec.encode()) + number(0) + sync
    for k in range(0, len(times), per_block):
        part = times[k:k + per_block]
        data = b"".join(record(k + i, t) for i, t in enumerate(part))
        if codec == "deflate":
            squeeze = zlib.compressobj(wbits=-15)
            data = squeeze.compress(data) + squeeze.flush()
        out += number(len(part)) + blob(data) + sync
    return out


def test_files_split_anywhere_give_the_same_records(spark, tmp_path):
    times = {"one.avro": [100.0 + i for i in range(137)], "two.avro": [float("nan"), 5.0], "packed.avro": [1.5] * 95}
    for n, (name, t) in enumerate(times.items()):
        (tmp_path / name).write_bytes(container(t, "deflate" if name == "packed.avro" else "null", seed=n))
    seen = []
    for split in (None, 1000, 97, 33):
        rows = avro_receptions(spark, str(tmp_path), split).collect()
        seen.append(sorted((r._file.split("/")[-1], r.record_index, str(r.timeAtServer), r.rawMessage, r.sensorSerialNumber, r.sensorType, tuple(r.tags), r.extra["k"]) for r in rows))
    want = sorted((name, i, str(t), None if i % 7 == 0 else "8D%026X" % i, i % 5 - 2, "ab"[i % 2], (i, -i) if i % 3 else (), bool(i % 2))
                  for name, ts in times.items() for i, t in enumerate(ts))
    assert all(s == want for s in seen)


def test_import_once_and_again(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "store")
    folder.mkdir()
    whole = container([3.0, 1.0, float("inf"), 2.0])
    files = {"a.avro": whole, "copy.avro": whole, "b.avro": container([9.0] * 25, "deflate"), "cut.avro": whole[:-20], "empty.avro": container([]),
             "other.avro": container([], schema={"type": "record", "name": "X", "fields": [{"name": "y", "type": "int"}]}), "text.avro": b"hello"}
    for name, data in files.items():
        (folder / name).write_bytes(data)
    listing = lambda: spark.createDataFrame([(str(folder / n), len(d), "m1") for n, d in files.items()] + [("notes.txt", 5, "m1")], "url string, size long, last_modified string")
    assert import_files(spark, listing(), root) == {"discovered": 7, "imported": 3, "skipped": 0, "failed": 4}
    rows = {r.url.split("/")[-1]: r for r in spark.read.parquet(root + "/manifests").collect()}
    assert rows["a.avro"].sha256 == hashlib.sha256(whole).hexdigest() == rows["copy.avro"].sha256
    assert (rows["a.avro"].record_count, rows["a.avro"].event_time_min, rows["a.avro"].event_time_max, rows["a.avro"].size_bytes) == (4, 1.0, 3.0, len(whole))
    assert sorted(p.name for p in (tmp_path / "store" / "raw").iterdir()) == sorted(f"{hashlib.sha256(files[n]).hexdigest()}.avro" for n in ("a.avro", "b.avro"))
    assert import_files(spark, listing(), root) == {"discovered": 7, "imported": 0, "skipped": 3, "failed": 4}
    files["cut.avro"] = whole + b""
    (folder / "cut.avro").write_bytes(whole)  # mended, and listed with its new size
    assert import_files(spark, listing(), root) == {"discovered": 7, "imported": 1, "skipped": 3, "failed": 3}
    assert import_files(spark, listing().limit(0), root)["discovered"] == 0
    reasons = {r.url.split("/")[-1]: r.error for r in spark.read.parquet(root + "/failures").collect()}
    assert "breaks off" in reasons["cut.avro"] and "no records" in reasons["empty.avro"] and "missing" in reasons["other.avro"] and "no Avro" in reasons["text.avro"]


def test_a_reader_refuses_other_records(spark, tmp_path):
    (tmp_path / "x.avro").write_bytes(container([], schema={"type": "record", "name": "X", "fields": [{"name": "y", "type": "int"}]}))
    with pytest.raises(ValueError, match="rawMessage"):
        avro_receptions(spark, str(tmp_path))
