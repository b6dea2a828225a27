"""What a task holds at once doesn't grow with the width of its rows, nor with the number of passes."""

import pyarrow as pa
from pyspark.sql import functions as F

from skylens.llm.common import keyed
from skylens.llm.toxicity import score_documents, train


def test_batches_of_wide_rows_are_small(spark):
    docs = keyed(spark.range(3000, numPartitions=1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("wide "), 2000).alias("text")))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], names=["n", "size"])

    got = docs.coalesce(1).mapInArrow(sizes, "n long, size long").collect()
    assert sum(r.n for r in got) == 3000 and max(r.size for r in got) < 4_100_000


def test_a_toxicity_model_goes_out_once(spark, monkeypatch):
    sent = []
    context = type(spark.sparkContext)
    broadcast = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    docs = keyed(spark.createDataFrame([(i, f"plain words {'nitwit' if i % 4 == 0 else 'here'} and {i}") for i in range(200)], "doc_id long, text string"))
    model = train(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    got = {r.doc_id: r.score for r in score_documents(docs, model).collect()}
    assert sum(x is model for x in sent) == 1 and model.calibration
    assert all(got[i] == model.score(f"plain words {'nitwit' if i % 4 == 0 else 'here'} and {i}")[0] for i in range(200))
