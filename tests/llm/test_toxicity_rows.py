"""Every labelled row outside the held-out fold is learned from, however many there are."""


def test_no_bound_on_labelled_rows(spark):
    from pyspark.sql import functions as F
    from skylens.llm.toxicity import fold, train
    n = 43_000
    word = F.translate(F.col("doc_id").cast("string"), "0123456789", "abcdefghij")
    docs = spark.range(n * 5 // 4).select(F.col("id").alias("doc_id")).select("doc_id", F.concat_ws(" ", word, F.concat(F.lit("q"), word)).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
    seen = docs.where(fold("doc_id") != 0).count()
    assert seen > 40_000
    model = train(docs, labels, max_entries=2 * n)
    assert len(model.words) == 2 * seen
