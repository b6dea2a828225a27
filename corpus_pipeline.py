"""The corpus pipeline: toxicity, exact dedup, near-dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and is
written as Parquet and read again before the next. All but the last return the columns of
``documents``: doc_id, text, lang, source, n_chars.

A document is rejected as toxic where its score is at least 0.5; of equal texts, and of documents
linked by 80 % of their five-word shingles, one stays; secrets are replaced by a mark (the document
stays, and n_chars follows its text); what remains is packed into sequences.

Nulls: a null text is an empty one for every decision and stays null where its document stays. Null
and repeated ids are rows of their own. Empty tables pass through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.llm.common import ROW, steady, table, with_rows, written
from skylens.llm.exact_dedup import exact_dedup
from skylens.llm.minhash import near_dedup
from skylens.llm.packing import pack_documents
from skylens.llm.secret_scan import redacted, scan
from skylens.llm.toxicity import toxicity

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The toxicity stage rests on a learned model, which SQL can't express.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose row key is in ``dropped``."""
    return with_rows(docs).join(dropped.select(ROW), ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = steady(docs)
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    return _without(docs, written(scored.where("predicted = 1").select(ROW), "toxic"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = steady(docs)
    return _without(docs, written(exact_dedup(docs).where(~F.col("kept")).select(ROW), "copies"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = steady(docs)
    return _without(docs, written(near_dedup(docs, k=5, percent=80).where(~F.col("first_of_group")).select(ROW), "near"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    docs = steady(docs)
    spans = written(scan(docs)[0].where("size(spans) > 0").select(ROW, "spans"), "spans")
    joined = with_rows(docs).join(spans, ROW, "left")
    text = F.when(F.col("spans").isNull(), F.col("text")).otherwise(redacted(F.col("text"), F.col("spans")))
    columns = [F.col(c) for c in docs.columns if c not in ("text", "n_chars")]
    out = joined.select(*columns, text.alias("text"), *([F.when(F.col("spans").isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long").alias("n_chars")]
                                                       if "n_chars" in docs.columns else []))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
