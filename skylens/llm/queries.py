"""Registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

_NORM = "regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.exact_dedup import exact_dedup
    return exact_dedup(table(spark, sf_dir, "documents")).drop("_row")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four-word shingles, as its contract asks."""
    from skylens.llm.minhash import near_dedup
    return near_dedup(table(spark, sf_dir, "documents"), k=4, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents, encoded with the pieces of a vocabulary file (by default the 32,000 public ones)."""
    import public_tokenizers
    from skylens.llm.sentencepiece import encode_documents, load
    return encode_documents(table(spark, sf_dir, "documents"), load(vocabulary or public_tokenizers.path("piece_bpe_32k.model"))).drop("_row")


def op4_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.pii import pseudonymise
    return pseudonymise(table(spark, sf_dir, "documents")).drop("_row")


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.chat import neighbouring_pairs
    return neighbouring_pairs(table(spark, sf_dir, "conversations"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("_row")


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.language_model import language_model
    return language_model(table(spark, sf_dir, "documents")).drop("_row")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.secret_scan import digests, scan
    return digests(scan(table(spark, sf_dir, "documents"))[0])


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.embedding_dedup import embedding_dedup
    return embedding_dedup(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.packing import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


def rebuilt_words(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with the repetitions that op11's contract plants: of every tenth document, by the
    CRC of its id, the words from some place on become copies of the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")
    planted = docs.select("doc_id", "text", h.alias("h")).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words"), F.floor(F.col("h") / 10)
    planted = planted.withColumn("a", g % n).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    text = F.expr("array_join(transform(sequence(0, size(words) - 1), i -> words[cast(if(i >= a, a + (i - a) % p, i) as int)]), ' ')")
    return planted.select("doc_id", F.when(n > 0, text).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.periodic_runs import periodic_runs
    found = periodic_runs(rebuilt_words(table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")))
    top = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return (found.withColumn("top", top)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.start")).alias("start"), F.col("top.length").alias("length"),
                    (-F.col("top.period")).alias("period"), F.expr("1000 * top.length div -top.period").alias("exponent_milli"),
                    F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def rebuilt_conversations(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(convs, turns) as op12's contract rebuilds them: the first h turns of a hundred's first
    conversation, then the own turns after the first h, where h is the CRC of the id modulo 6."""
    from skylens.llm.common import written
    from skylens.llm.prefix_trie import ordered_turns
    own = written(ordered_turns(conversations), "own")
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).alias("h")
    sizes = own.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("n"))
    convs = own.select("conv_id").distinct().select("conv_id", (F.col("conv_id") - F.col("conv_id") % 100).alias("base"), h)
    convs = written(convs.join(sizes, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("lent")), "convs")
    lent = own.where("pos < 5").select(F.col("conv_id").alias("base"), "pos", "role", "text")
    lent = convs.join(lent, "base").where("pos < h").select("conv_id", "pos", "role", "text")
    kept = own.join(convs, "conv_id").where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "role", "text")
    return convs.select("conv_id"), lent.unionByName(kept)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skylens.llm.prefix_trie import prefix_trie
    return prefix_trie(*rebuilt_conversations(table(spark, sf_dir, "conversations")))


def op13_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """16 shards of near equal bytes."""
    from skylens.llm.kd_shards import kd_shards
    return (kd_shards(table(spark, sf_dir, "documents"), ["n_chars", "lang", "source"], shards=16)
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": op1_exact_dedup,
        "op2_minhash": op2_minhash,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_pii_surrogates": op4_pii_surrogates,
        "op5_preferences": op5_preferences,
        "op6_toxicity": op6_toxicity,
        "op7_language_model": op7_language_model,
        "op8_secret_scan": op8_secret_scan,
        "op9_embedding_dedup": op9_embedding_dedup,
        "op10_packing": op10_packing,
        "op11_periodic_runs": op11_periodic_runs,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_kd_shards": op13_kd_shards,
    }


_SHINGLES = """
            WITH RECURSIVE w AS (
                SELECT doc_id, list_filter(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
                FROM documents),
            s AS (
                SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
                    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh
                FROM w),
            n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),"""

# (kind, pattern, group whose length counts, least length)
_SECRETS = (
    ("assign", "((?i:password|passwd|secret|token|api_?key))[\"'']?\\x20*[:=]\\x20*[\"'']?([A-Za-z0-9+/_.=-]+)", 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("jwt", "eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]*", 0, 0),
)


def _secret_sql() -> str:
    parts = " UNION ALL ".join(f"""
                SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least, i, length(gaps[i]) AS gap, length(ms[i]) AS size, length(hs[i]) AS held
                FROM (SELECT doc_id, ms, hs, gaps, unnest(range(1, len(ms) + 1)) AS i FROM (
                    SELECT doc_id, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {g}) AS hs,
                           string_split_regex(text, '{p}') AS gaps FROM documents WHERE text IS NOT NULL))"""
                               for rank, (kind, p, g, least) in enumerate(_SECRETS))
    return f"""
            WITH m AS ({parts}),
            placed AS (SELECT *, sum(gap + size) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM m),
            f AS (SELECT doc_id, rank, kind, stop - size AS start, kind || ':' || (stop - size)::BIGINT || ':' || stop::BIGINT AS span FROM placed WHERE held >= least),
            g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
                         count(*) FILTER (kind = 'hex') AS n_hex,
                         coalesce(string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
                  FROM f GROUP BY doc_id)
            SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
                   sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(coalesce(text, '')) AS blob_sha256
            FROM documents LEFT JOIN g USING (doc_id)"""


#: Unsigned CRC32 of the decimal id ``{0}``: for each byte one exclusive or (with the byte) and eight shifts (marked -1).
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({0}::VARCHAR) + 1),
                    lambda i: list_concat([ascii(({0}::VARCHAR)[i])::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
                    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _runs_sql() -> str:
    """Equal words q apart, their unbroken stretches, and the smallest period of each stretch."""
    return f"""
            WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws, {_CRC.format("doc_id")} AS h FROM documents),
            k AS (SELECT *, len(ws) AS n, h // 10 AS g, h % 10 = 0 AND len(ws) > 0 AS planted FROM d),
            ap AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM k),
            ps AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM ap),
            w AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(CASE WHEN planted THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END]) ELSE ws END) AS word FROM ps),
            e AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i WHERE (y.i - x.i) * 4 <= x.n),
            o AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM e),
            m AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM o GROUP BY doc_id, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
            r AS (SELECT doc_id, start, length, min(q) AS period FROM m GROUP BY doc_id, start, length),
            s AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
                         min(struct_pack(l := -length, s := start, p := period)) AS top FROM r GROUP BY doc_id),
            c AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM w
                  WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = w.doc_id AND w.i >= r.start + r.period AND w.i < r.start + r.length) GROUP BY doc_id)
            SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, -top.l AS length, top.p AS period, (1000 * -top.l) // top.p AS exponent_milli,
                   sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
            FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN c USING (doc_id)"""


def _trie_sql() -> str:
    """Nodes as groups of equal prefixes; subtrees as all nodes on whose smallest member's path a node lies."""
    return f"""
            WITH o AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
                       FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
            h AS (SELECT conv_id, l, {_CRC.format("conv_id")} % 6 AS h FROM o),
            b AS (SELECT x.conv_id, list_concat(coalesce(y.l[1:x.h], []), x.l[x.h + 1:]) AS l FROM h x LEFT JOIN o y ON y.conv_id = x.conv_id - x.conv_id % 100),
            p AS (SELECT conv_id, l, unnest(range(len(l) + 1)) AS depth FROM b),
            y AS (SELECT conv_id, depth, min(conv_id) OVER (PARTITION BY depth, l[1:depth]) AS node, len(l) = depth AS ends,
                          CASE WHEN depth = 0 THEN 0 ELSE length(l[depth].text) END AS size FROM p),
            n AS (SELECT node, depth, count(*) AS n_convs, min(size) AS size, string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ids FROM y GROUP BY node, depth),
            k AS (SELECT n.*, u.node AS parent FROM n LEFT JOIN y u ON u.conv_id = n.node AND u.depth = n.depth - 1),
            c AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM k WHERE depth > 0 GROUP BY ALL),
            t AS (SELECT k.*, coalesce(n_children, 0) AS n_children FROM k LEFT JOIN c USING (node, depth)),
            s AS (SELECT a.node, a.depth, count(*) FILTER (t.n_children = 0) AS n_leaves, sum((t.n_convs - 1) * t.size)::BIGINT AS saved_tokens
                  FROM t JOIN y a ON a.conv_id = t.node AND a.depth <= t.depth GROUP BY a.node, a.depth)
            SELECT node AS conv_id, depth, parent AS parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
            FROM t JOIN s USING (node, depth)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": f"""
            WITH n AS (SELECT doc_id, {_NORM} AS norm FROM documents),
                 g AS (SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY norm)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
            FROM n JOIN g USING (norm)""",
        "op2_minhash": f"""{_SHINGLES}
            c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
            e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
            r AS (SELECT doc_id AS node, doc_id AS seen FROM documents UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
            k AS (SELECT node AS doc_id, min(seen) AS component_id FROM r GROUP BY node)
            SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM k LEFT JOIN n USING (doc_id)""",
        "op5_preferences": """
            WITH t AS (SELECT conv_id, floor(conv_id / 2)::BIGINT AS pair_id, conv_id % 2 = 0 AS is_chosen, list(DISTINCT
                           struct_pack(turn := turn, role := coalesce(role, ''), text := coalesce(text, ''))) AS l
                       FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
            s AS (SELECT pair_id, conv_id, is_chosen, list_transform(list_sort(l), lambda x: struct_pack(role := x.role, text := x.text)) AS l FROM t),
            p AS (SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, c.conv_id AS chosen_id, r.conv_id AS rejected_id, c.l AS c, r.l AS r
                  FROM (SELECT * FROM s WHERE is_chosen) c FULL JOIN (SELECT * FROM s WHERE NOT is_chosen) r ON c.pair_id = r.pair_id),
            k AS (SELECT *, CASE WHEN c IS NULL OR r IS NULL THEN 0 ELSE coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1),
                      lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)) - 1, least(len(c), len(r))) END AS n FROM p),
            m AS (SELECT *, list_transform(c, lambda x: '<|' || replace(x.role, '<|', '<​|') || '|>' || chr(10) || replace(x.text, '<|', '<​|') || '<|end|>' || chr(10)) AS ct,
                            list_transform(r, lambda x: '<|' || replace(x.role, '<|', '<​|') || '|>' || chr(10) || replace(x.text, '<|', '<​|') || '<|end|>' || chr(10)) AS rt FROM k),
            e AS (SELECT *, list_transform(range(n + 1, len(c) + 1), lambda i: CASE WHEN c[i].role = 'assistant' THEN
                                (length(array_to_string(ct[n + 1:i], '')) - length(ct[i]) + 14) || ':' || length(array_to_string(ct[n + 1:i], '')) END) AS cs,
                            list_transform(range(n + 1, len(r) + 1), lambda i: CASE WHEN r[i].role = 'assistant' THEN
                                (length(array_to_string(rt[n + 1:i], '')) - length(rt[i]) + 14) || ':' || length(array_to_string(rt[n + 1:i], '')) END) AS rs FROM m)
            SELECT pair_id, chosen_id, rejected_id, n::BIGINT AS prompt_turns, array_to_string(coalesce(ct, rt)[1:n], '') AS prompt,
                   array_to_string(ct[n + 1:], '') AS chosen, array_to_string(rt[n + 1:], '') AS rejected,
                   array_to_string(list_filter(cs, lambda x: x IS NOT NULL), ',') AS chosen_learned,
                   array_to_string(list_filter(rs, lambda x: x IS NOT NULL), ',') AS rejected_learned,
                   CASE WHEN chosen_id IS NULL OR rejected_id IS NULL THEN 'single' WHEN n = len(c) AND n = len(r) THEN 'equal' ELSE 'pair' END AS status
            FROM e""",
        "op8_secret_scan": _secret_sql(),
        "op9_embedding_dedup": """
            WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
                                 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
                                   AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
            e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95),
            r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
            k AS (SELECT node AS vec_id, min(seen) AS component_id FROM r GROUP BY node),
            d AS (SELECT a AS vec_id, count(*) AS n_links FROM e GROUP BY a)
            SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM k LEFT JOIN d USING (vec_id)""",
        "op11_periodic_runs": _runs_sql(),
        "op12_prefix_trie": _trie_sql(),
    }
