"""The pipeline's stages against a brute-force version that takes the learned scores as given."""

import random

from pyspark.sql import functions as F

import corpus_pipeline
from skylens.llm.toxicity import toxicity
from test_dedup import components, norm
from test_private import brute


def fixture(spark, folder):
    rng = random.Random(9)
    words = ["".join(rng.choices("aeiourtnslm", k=rng.randint(3, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        if rows and rng.random() < 0.3:
            own = rows[rng.randrange(len(rows))][1].split(" ")
            if rng.random() < 0.5:
                own = own[:-1] + rng.choices(words, k=1)
        else:
            own = rng.choices(words, k=rng.randint(1, 120))
        bad = rng.random() < 0.2
        if bad:
            own = own + ["blockhead"]
        if rng.random() < 0.1:
            own = own + ["token=0123456789abcdef0123"]
        rows.append((i, " ".join(own)))
        labels.append((i, 0, int("blockhead" in own)))
    rows += [(400, None), (401, ""), (402, " "), (None, "null id"), (5, rows[5][1]), (5, rows[5][1])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_stages(spark, tmp_path):
    folder = f"file://{tmp_path}"
    fixture(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "secrets", "packing"]
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    kept = sorted(docs.collect(), key=key)
    toxic = {(r.doc_id, r.text) for r in toxicity(docs, labels).where("predicted = 1").join(docs.select("doc_id", "text"), "doc_id").collect()}
    stage = docs
    for n, (name, step) in enumerate(corpus_pipeline.STAGES[:4]):
        step(spark, stage, folder).write.parquet(f"{folder}/out{n}")
        stage = spark.read.parquet(f"{folder}/out{n}")
        assert stage.columns == docs.columns
        if name == "toxicity":
            kept = [r for r in kept if (r.doc_id, r.text) not in toxic]
            assert not any("blockhead" in (r.text or "") for r in kept)
        elif name == "exact_dedup":
            first = {}
            for r in kept:
                first.setdefault(norm(r.text), r)
            kept = sorted(first.values(), key=key)
        elif name == "near_dedup":
            sets, least, _ = components([(r.doc_id, r.text) for r in kept], 5, 80)
            kept = [r for k, r in enumerate(kept) if not sets[k] or least[k] == r.doc_id]
        if name != "secrets":
            assert [(r.doc_id, r.text, r.n_chars) for r in sorted(stage.collect(), key=key)] == [(r.doc_id, r.text, r.n_chars) for r in kept], name
        else:
            got = sorted(stage.collect(), key=key)
            assert [r.doc_id for r in got] == [r.doc_id for r in kept]
            for new, old in zip(got, kept):
                assert not brute(new.text) and (new.text == old.text) == (not brute(old.text)) and new.n_chars == len(new.text or "")
    packed = corpus_pipeline.pack(spark, stage, folder)
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == sum(r.doc_id is not None for r in kept)
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0
