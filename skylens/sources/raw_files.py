"""SRC-9 / SRC-10 / SRC-11: raw reception files, their profile, replay and import.

``avro_receptions`` reads the containers themselves (``sources.avro``); the other functions accept any
DataFrame holding rawMessage, timeAtServer, sensorSerialNumber and optional sensor metadata.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skylens.plans import fs

LISTING = ("url", "size", "last_modified", "etag")
REQUIRED = ("rawMessage", "timeAtServer", "sensorSerialNumber")


def profile(raw: DataFrame) -> DataFrame:
    """SRC-9: record count and min/max over finite reception times; refuses wrong or empty input."""
    missing = [c for c in REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"not a raw reception file: {', '.join(missing)} missing")
    t = F.col("timeAtServer").cast("double")
    finite = t.isNotNull() & ~F.isnan(t) & (F.abs(t) < F.lit(float("inf")))
    if raw.isEmpty():
        raise ValueError("the file holds no records")
    out = raw.agg(F.count(F.lit(1)).alias("record_count"), F.min(F.when(finite, t)).alias("event_time_min"),
                  F.max(F.when(finite, t)).alias("event_time_max")).withColumn("event_time_basis", F.lit("timeAtServer"))
    return out


def with_record_index(raw: DataFrame, order: str | None = None) -> DataFrame:
    """Zero-based record index in file order (``monotonically_increasing_id`` is not dense, so a
    per-partition count prefix is added; no single-task window over the whole input)."""
    tagged = raw.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    # One row per input partition, so the prefix sum is bounded by the partition count; Spark
    # broadcasts it or not by its measured size.
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
                           .alias("_off"))
    local = Window.partitionBy("_pid").orderBy("_mid")
    return (tagged.join(offsets, "_pid")
            .withColumn("record_index", F.coalesce(F.col("_off"), F.lit(0)) + F.row_number().over(local) - 1)
            .drop("_pid", "_mid", "_off"))


def replay_receptions(raw: DataFrame, *, checksum: str, run_id: str, source_url: str, max_rows: int | None,
                      start: int = 0, released_at: float = 0.0) -> DataFrame:
    """SRC-10: receptions [start, start + max_rows) with stable ids and all source fields as sorted-key JSON.

    ``max_rows=None`` replays everything from ``start`` on. A slice without records is refused.
    Delivery ids follow from run, file and index, so a recomputed partition gives the same ones.
    """
    if not run_id.strip() or start < 0 or (max_rows is not None and max_rows < 1):
        raise ValueError("replay needs a run id, a start of 0 or more, and a positive number of rows or None")
    indexed = with_record_index(raw).where(F.col("record_index") >= start)
    if max_rows is not None:
        indexed = indexed.where(F.col("record_index") < start + max_rows)
    if indexed.isEmpty():
        raise ValueError("the slice to replay holds no records")
    fields = sorted(c for c in raw.columns)
    source_json = F.to_json(F.struct(*[F.col(c) for c in fields]), {"ignoreNullFields": "false"})
    t = F.col("timeAtServer").cast("double")
    finite = ~F.isnan(t) & (F.abs(t) < F.lit(float("inf")))
    return indexed.select(
        F.struct(
            F.lit(1).alias("schema_version"), F.lit("raw_reception").alias("record_type"), F.lit("replay").alias("mode"),
            F.lit(run_id).alias("run_id"), F.lit("raw").alias("dataset_id"),
            F.sha2(F.concat_ws(":", F.lit(checksum), F.col("record_index").cast("string")), 256).alias("reception_id"),
            F.sha2(F.concat_ws(":", F.lit(run_id), F.lit(checksum), F.col("record_index").cast("string")), 256).alias("delivery_id"), F.lit(checksum).alias("source_sha256"),
            F.lit(source_url).alias("source_url"), F.col("record_index"), F.col("rawMessage").alias("raw_message"),
            F.col("sensorSerialNumber").cast("int").alias("receiver_id"),
            F.when(finite, t).alias("source_reception_time"), F.when(finite, t).alias("event_time"),
            F.lit("timeAtServer").alias("event_time_basis"), F.lit(released_at).alias("replay_released_at"),
            source_json.alias("source_record_json"), F.sha2(source_json, 256).alias("source_payload_sha256"))
        .alias("envelope"))


def catalog(files: DataFrame, manifests: DataFrame) -> DataFrame:
    """SRC-11: ``.avro`` files of a known, positive size not yet imported.

    The identity is the sha256 of the listing's own fields (``LISTING``), whatever else a listing carries.
    """
    listed = [F.col(c) for c in LISTING if c in files.columns]
    candidates = (files.where(F.col("url").endswith(".avro") & (F.col("size") > 0))
                  .withColumn("identity", F.sha2(F.to_json(F.struct(*listed), {"ignoreNullFields": "false"}), 256)))
    return candidates.join(manifests.select("identity"), "identity", "left_anti")


def avro_receptions(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """SRC-9: the records of the Avro files under ``path`` with ``record_index``, a record's place in its file.

    The index is a record's place in its block plus the records of the file's blocks before, from a table of
    one row a block; neither depends on how files are split over tasks.
    """
    from skylens.sources.avro import AvroFiles
    spark.dataSource.register(AvroFiles)
    reader = spark.read.format("avro_files")
    rows = (reader.option("splitBytes", split_bytes) if split_bytes else reader).load(path)
    if missing := [c for c in REQUIRED if c not in rows.columns]:
        raise ValueError(f"not a raw reception file: {', '.join(missing)} missing")
    blocks = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select("_file", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return (rows.join(before, ["_file", "_block"]).withColumn("record_index", F.col("_before") + F.col("_place"))
            .drop("_block", "_place", "_before"))


MANIFEST = "identity string, url string, sha256 string, size_bytes long, object string, record_count long, event_time_min double, event_time_max double, error string"


def _taken_in(root: str):
    """One file after another: hashed, checked to its last record, and kept under its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as arrow_fs

        from skylens.sources.avro import Container, opened

        names = ("identity", "url", "sha256", "size_bytes", "object", "record_count", "event_time_min", "event_time_max", "error")
        store, base = arrow_fs.FileSystem.from_uri(root) if "://" in root else (arrow_fs.LocalFileSystem(), root)
        for batch in batches:
            rows = []
            for identity, url in zip(batch.column("identity").to_pylist(), batch.column("url").to_pylist()):
                row = dict.fromkeys(names) | {"identity": identity, "url": url}
                try:
                    digest, size = hashlib.sha256(), 0
                    with opened(url) as stream:
                        while data := stream.read(1 << 20):
                            digest.update(data)
                            size += len(data)
                        stream.seek(0)
                        container = Container(stream)
                        if missing := [c for c in REQUIRED if container.type.get_field_index(c) < 0]:
                            raise ValueError(f"fields are missing: {', '.join(missing)}")
                        count, least, most = 0, None, None
                        for _, records in container.blocks(0, size):
                            count += len(records)
                            for t in (r["timeAtServer"] for r in records):
                                if t is not None and math.isfinite(t):
                                    least, most = t if least is None else min(least, t), t if most is None else max(most, t)
                        if not count:
                            raise ValueError("the file holds no records")
                        kept = f"{base}/raw/{digest.hexdigest()}.avro"
                        if store.get_file_info(kept).type == arrow_fs.FileType.NotFound:
                            store.create_dir(f"{base}/raw", recursive=True)
                            part = f"{kept}.{uuid.uuid4().hex}"  # a lost task leaves a part, never half an object
                            stream.seek(0)
                            with store.open_output_stream(part) as out:
                                while data := stream.read(1 << 20):
                                    out.write(data)
                            store.move(part, kept)
                    row |= {"sha256": digest.hexdigest(), "size_bytes": size, "object": kept, "record_count": count, "event_time_min": least, "event_time_max": most}
                except Exception as error:  # noqa: BLE001 - a file that can't be read is a row, and the rest goes on
                    row["error"] = f"{type(error).__name__}: {error}"[:500]
                rows.append(row)
            kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(names, kinds))))
    return run


def import_files(spark: SparkSession, listing: DataFrame, root: str) -> dict[str, int]:
    """SRC-11: takes every listed revision in once; returns how many were discovered, imported, skipped, failed.

    A file is hashed and read through on an executor, kept as ``root/raw/<sha256>.avro`` (equal contents
    once) and gets a row in ``root/manifests``, the marker that it is done. A file that fails gets none, so the
    next import tries it again; why it failed is a row of ``root/failures``.
    """
    root = root.rstrip("/")
    known = spark.read.schema(MANIFEST).parquet(f"{root}/manifests") if fs.exists(spark, f"{root}/manifests") else spark.createDataFrame([], MANIFEST)
    everything = catalog(listing, known.limit(0))
    fresh = catalog(listing, known).select("identity", "url").distinct()
    # a file is a task's unit of work, however small the listing is
    taken = fresh.repartition(spark.sparkContext.defaultParallelism * 4, "identity").mapInArrow(_taken_in(root), MANIFEST)
    attempt = f"{root}/attempts/{uuid.uuid4().hex}"
    taken.write.parquet(attempt)
    taken = spark.read.schema(MANIFEST).parquet(attempt)
    taken.where("error IS NULL").write.mode("append").parquet(f"{root}/manifests")
    taken.where("error IS NOT NULL").write.mode("append").parquet(f"{root}/failures")
    found = taken.agg(F.count_if(F.col("error").isNull()).alias("imported"), F.count_if(F.col("error").isNotNull()).alias("failed")).first()
    discovered = everything.select("identity").distinct().count()
    return {"discovered": discovered, "imported": found["imported"], "skipped": discovered - found["imported"] - found["failed"], "failed": found["failed"]}
