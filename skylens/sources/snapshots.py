"""SRC-8 / EXP-1 / SNK-13: snapshot documents -> verified state events.

A snapshot document is JSON {schema_version, source_sha256, collected_at, bounding_box,
response: {time, states: [[...], ...]}} stored under a content-addressed key.  The
digest is recomputed by Spark from a canonical text of (bounding_box, response) built
from the VARIANT rendering, and must equal both the stored digest and the object key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.functions.constants import MIN_STATE_FIELDS, STATE_FIELDS
from skylens.operators.envelope import materialize


def canonical_digest(document) -> F.Column:
    """sha256 of the canonical text of {bounding_box, response} (keys sorted by the VARIANT encoder)."""
    source = F.to_json(F.parse_json(F.to_json(F.struct(
        F.variant_get(document, "$.bounding_box", "variant").alias("bounding_box"),
        F.variant_get(document, "$.response", "variant").alias("response")))))
    return F.sha2(source, 256)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """One row per snapshot file: path, document (VARIANT), digest check columns."""
    return snapshot_documents(spark.read.text(path, wholetext=True).withColumn("path", F.input_file_name()))


def snapshot_documents(objects: DataFrame) -> DataFrame:
    """The same of a table of objects (path, value), as many small documents are better kept."""
    docs = materialize(objects, {"document": F.try_parse_json("value")})
    key_digest = F.regexp_extract("path", r"([0-9a-f]{64})\.json$", 1)
    return docs.select("path", "document",
                       F.variant_get("document", "$.source_sha256", "string").alias("source_sha256"),
                       key_digest.alias("key_digest"), canonical_digest(F.col("document")).alias("digest"))


def verified(snapshots: DataFrame) -> DataFrame:
    """Snapshots whose recomputed digest matches the stored digest and the object key."""
    return snapshots.where((F.col("digest") == F.col("source_sha256")) & (F.col("digest") == F.col("key_digest")))


def corrupted(snapshots: DataFrame) -> DataFrame:
    return snapshots.where(~((F.col("digest") == F.col("source_sha256")) & (F.col("digest") == F.col("key_digest")))
                           | F.col("digest").isNull())


def state_events(snapshots: DataFrame) -> DataFrame:
    """EXP-1: one event per state row (no rows for null/empty states); rows that are not a list of
    >= 17 entries starting with a string are returned with ``row_error``."""
    doc = F.col("document")
    rows = snapshots.select(
        "path", "source_sha256",
        F.variant_get(doc, "$.response.time", "bigint").alias("snapshot_time"),
        F.try_variant_get(doc, "$.collected_at", "double").alias("collected_at"),
        F.variant_get(doc, "$.bounding_box", "variant").alias("bounding_box"),
        F.explode(F.try_variant_get(doc, "$.response.states", "array<variant>")).alias("row"))
    error, state = _typed_row(F.col("row"))
    return rows.select("*", error.alias("row_error"), state.alias("state"), F.to_json("row").alias("source_row_text"))


BOUNDS = ("lamin", "lamax", "lomin", "lomax")


def archived_rows(snapshots: DataFrame) -> DataFrame:
    """SRC-8 and EXP-1 in one pass: a row per state row, and one without text for an empty document.

    ``intact`` tells that the digest matches both the stored one and the object key; the document's
    box is in ``BOUNDS``.
    """
    doc, rows = F.col("document"), F.try_variant_get("document", "$.response.states", "array<variant>")
    each = snapshots.select(
        "path", "source_sha256", F.variant_get(doc, "$.response.time", "bigint").alias("snapshot_time"),
        F.try_variant_get(doc, "$.collected_at", "double").alias("collected_at"),
        *[F.try_variant_get(doc, f"$.bounding_box.{b}", "double").alias(b) for b in BOUNDS],
        F.coalesce((F.col("digest") == F.col("source_sha256")) & (F.col("digest") == F.col("key_digest")), F.lit(False)).alias("intact"),
        F.explode_outer(rows).alias("row"))
    error, state = _typed_row(F.col("row"))
    return each.select("path", "source_sha256", "snapshot_time", "collected_at", *BOUNDS, "intact",
                       F.when(F.col("row").isNotNull(), error).alias("row_error"), state.alias("state"), F.to_json("row").alias("source_row_text"))


def _typed_row(row):
    """(error or null, typed state) of a positional source row."""
    text, flags = ("icao24", "callsign", "origin_country", "squawk"), ("on_ground", "spi")
    enough = F.array_size(F.try_variant_get(row, "$", "array<variant>")) >= MIN_STATE_FIELDS
    named = F.schema_of_variant(F.variant_get(row, "$[0]", "variant")) == "STRING"
    kind = {**dict.fromkeys(text, "string"), **dict.fromkeys(flags, "boolean")}
    state = F.struct(*[F.try_variant_get(row, f"$[{i}]", kind.get(name, "double")).alias(name) for i, name in enumerate(STATE_FIELDS)])
    return F.when(~F.coalesce(enough & named, F.lit(False)), F.lit("not a state vector")), state


def empty_snapshots(snapshots: DataFrame) -> DataFrame:
    states = F.try_variant_get("document", "$.response.states", "array<variant>")
    return snapshots.where(states.isNull() | (F.array_size(states) == 0))


def with_snapshot_key(documents: DataFrame, text: str = "value", prefix: str = "snapshots/") -> DataFrame:
    """SNK-13 producer side: digest and content-addressed key of JSON snapshot documents.

    The digest uses the same canonical rendering as the reader, so a stored snapshot verifies.
    """
    doc = F.try_parse_json(F.col(text))
    digest = canonical_digest(doc)
    return documents.withColumn("source_sha256", digest).withColumn(
        "key", F.concat(F.lit(prefix), digest, F.lit(".json")))
