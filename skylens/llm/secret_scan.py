"""Secret scans with an incremental blob ledger, in DataFrame functions only.

Every version of a text is a blob named by its SHA-256. The ledger holds, for each blob, the rule
versions that have scanned it and the spans they found. A scan takes the blobs for which some rule
version is missing, scans one copy of each with those rules alone, adds rows to the ledger, and
joins the findings of all current rules back to every path that holds the blob.

Scale: texts are hashed in place, and only texts that still need a scan move (once). A blob that a
third of all paths hold is one scan; the join back is of two written tables, so the adaptive skew
join splits its paths. The ledger is a Parquet table that
``scan_kept`` reads and appends to; the registered queries call ``scan`` with no ledger and scan all.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skylens.llm.common import ROW, first_row, keyed, written


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0  # the part whose length counts
    least: int = 0

    @property
    def key(self) -> str:
        return f"{self.kind}/{self.version}"


#: Patterns and least lengths; of runs of one class, a bounded repeat finds the same matches.
BASE = (
    Rule("assign", 1, "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", 1, "AKIA[A-Z0-9]{14,}"),
    Rule("hex", 1, "[0-9a-f]{16,}"),
)
MORE = (
    Rule("pem", 1, "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]*"),
)
RULES = BASE + MORE
LEDGER = "blob binary, rules array<string>, spans array<struct<start: long, rank: int, end: long, kind: string, rule: string>>"


def _findings(texts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(_row, spans) of the rows of ``texts`` (_row, text, todo) in which a rule of ``todo`` finds something.

    A match begins after all gaps and matches before it; both are counted in code points.
    """
    hits = []
    for rank, rule in enumerate(rules):
        found = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0))
        held = F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group))
        hits.append(F.when(F.array_contains("todo", rule.key) & F.col("text").rlike(rule.pattern), F.struct(
            F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), F.lit(rule.key).alias("rule"), F.lit(rule.least).alias("least"),
            F.transform(F.split("text", rule.pattern, -1), lambda x: F.length(x).cast("long")).alias("gaps"),
            F.transform(found, lambda x: F.length(x).cast("long")).alias("sizes"),
            F.transform(held, lambda x: F.length(x).cast("long")).alias("held"))))
    any_rule = "|".join(f"(?:{r.pattern})" for r in rules)
    each = (texts.where(F.col("text").rlike(any_rule)).select(ROW, F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h"))
            .select(ROW, "h.rank", "h.kind", "h.rule", "h.least",
                    F.posexplode(F.arrays_zip(F.col("h.gaps").alias("gap"), F.col("h.sizes").alias("size"), F.col("h.held").alias("held"))).alias("k", "m"))
            .where(F.col("m.size").isNotNull())
            .select(ROW, "rank", "kind", "rule", "least", "k", F.col("m.gap").alias("gap"), F.col("m.size").alias("size"), F.col("m.held").alias("held")))
    until = F.expr(f"sum(gap + size) OVER (PARTITION BY {ROW}, rank ORDER BY k)")
    return (each.withColumn("end", until).where("held >= least")
            .groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct((F.col("end") - F.col("size")).alias("start"), "rank", "end", "kind", "rule"))).alias("spans")))


def scan(df: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(paths, new ledger rows) for ``df``: paths are (_row, doc_id, blob, spans), one per input row.

    ``ledger`` has the columns of ``LEDGER``; none means that nothing was scanned. Null text is the
    empty blob, which has no spans. Null and repeated ids are paths of their own; equal texts share
    their findings; other columns are ignored; an empty table gives no rows and no ledger rows.
    """
    docs = keyed(df, id_col, text_col)
    paths = written(docs.select(ROW, "doc_id", F.unhex(F.sha2("text", 256)).alias("blob")), "paths")
    blobs = paths.groupBy("blob").agg(F.min(first_row()).alias("rep")).select("blob", F.col("rep.row").alias(ROW))
    every = F.array(*[F.lit(r.key) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", every)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        todo = (blobs.join(seen, "blob", "left").select("blob", ROW, F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
                .where("size(todo) > 0"))
    todo = written(todo, "todo")
    found = written(_findings(docs.select(ROW, "text").join(todo.select(ROW, "todo"), ROW), rules), "found")
    spans_type = "array<struct<start: bigint, rank: int, end: bigint, kind: string, rule: string>>"
    fresh = written(todo.join(found, ROW, "left").select("blob", F.col("todo").alias("rules"), F.coalesce("spans", F.array().cast(spans_type)).alias("spans")), "fresh")
    known = fresh if ledger is None else fresh.unionByName(ledger.select("blob", "rules", "spans"))
    current = [r.key for r in rules]
    findings = (known.where("size(spans) > 0").groupBy("blob").agg(F.flatten(F.collect_list("spans")).alias("all"))
                .select("blob", F.array_sort(F.filter(F.array_distinct("all"), lambda s: s["rule"].isin(current))).alias("spans")))
    findings = written(findings, "findings")
    return paths.join(findings, "blob", "left").select(ROW, "doc_id", "blob", F.coalesce("spans", F.array().cast(spans_type)).alias("spans")), fresh


def scan_kept(df: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The paths of ``scan`` by the ledger at ``path``, which is made if missing; what was scanned is appended.

    Runs that share a ledger go one after the other; a blob that two scan at once is held twice, with the same findings.
    """
    spark = df.sparkSession
    spark.createDataFrame([], LEDGER).write.mode("ignore").parquet(path)
    paths, fresh = scan(df, spark.read.schema(LEDGER).parquet(path), rules, id_col, text_col)
    fresh.write.mode("append").parquet(path)
    return paths


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(paths: DataFrame) -> DataFrame:
    """Per path: doc_id, counts of the base kinds, the hash of the base spans, all spans, and the blob's name."""
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return paths.select("doc_id", *[count(r.kind) for r in BASE], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), F.lower(F.hex("blob")).alias("blob_sha256"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with each stretch that spans cover (overlapping ones as one) replaced by ``mark``."""
    start = F.aggregate(spans, F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
                        lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
                            s["end"].alias("at"),
                            F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], F.array(
                                F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)))).alias("out"))),
                        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))))
    return F.when(F.size(spans) > 0, start).otherwise(text)
