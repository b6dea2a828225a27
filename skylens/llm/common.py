"""Helpers shared by the training-data operators.

``keyed`` gives every input row a key of its own, so null or repeated document ids never merge
rows; ``written`` cuts lineage with a Parquet table in the cluster's shared folder; and
``connected_components`` labels a graph by contraction without bringing any of it to the driver.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

SPACES = "[\\x20\\x09-\\x0D]+"
ROW = "_row"
_LOCAL_FOLDERS: dict[str, str] = {}
_SHIPPED: set[str] = set()
#: Wide rows make large batches: Spark reads 4,096 rows at once and hands 10,000 (64 MB at most) to Python, which has them
#: in the JVM's buffers, in Arrow's and as Python's strings. Where the session has Spark's own values, batches are bounded closer.
_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "4000000"), "spark.sql.parquet.columnarReaderBatchSize": ("4096", "1024")}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the executors, once per application, so that tasks can import it there; bounds batches."""
    for key, (usual, own) in _BATCHES.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, own)
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        _SHIPPED.add(app)
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="skylens-code-"), "skylens-llm.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder in (package, os.path.join(package, "llm")):
                for name in sorted(os.listdir(folder)):
                    if name.endswith(".py"):
                        out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(package)))
        spark.sparkContext.addPyFile(archive)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where that is unset and Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="skylens-llm-")
    return _LOCAL_FOLDERS[app]


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lost executors recompute nothing before it."""
    spark = ship(df.sparkSession)
    path = f"{shared_folder(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Plans of these nodes alone read stored rows one by one, so a row has a file and a place in it.
_STORED = {"Relation", "Project", "Filter"}


def steady(df: DataFrame) -> DataFrame:
    """``df`` itself if it is read from the files of one table, row by row; else (a shuffle may deal rows out
    differently each time) a written copy."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    nodes = re.findall(r"^[ :+|-]*(\w+)", plan, re.M)
    return df if set(nodes) <= _STORED and nodes.count("Relation") == 1 else written(df, "steady")


def with_rows(df: DataFrame) -> DataFrame:
    """``df`` and ``_row``, the number of a row's file (in the order of their paths) and its place in it.

    Neither depends on how files are split over tasks, so the key is the same at every reading, also when
    executors come or go between two. Files are numbered by a table of one row a file.
    """
    df = steady(df)
    names = df.select(F.col("_metadata.file_path").alias("_path")).distinct()
    files = names.select("_path", F.row_number().over(Window.orderBy("_path")).cast("long").alias("_file"))
    files = written(files, "files")
    placed = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_place")).join(F.broadcast(files), "_path")
    return placed.withColumn(ROW, F.shiftleft("_file", 40).bitwiseOR(F.col("_place"))).drop("_path", "_place", "_file")


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, text); ``_row`` is the same at every reading of the result.

    Other columns are left out here, so columns with clashing names can't reach an operator.
    """
    ship(df.sparkSession)
    rows = with_rows(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return rows.select(ROW, F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def one_space(text: Column) -> Column:
    """Every run of space, tab, line feed, vertical tab, form feed or return as one space."""
    return F.regexp_replace(text, SPACES, " ")


def first_row(id_col: str = "doc_id", row_col: str = ROW) -> Column:
    """Ordering key of the row that stays: smallest id, nulls last, then the smallest row key."""
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("doc_id"), F.col(row_col).alias("row"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b: long); component is its smallest node.

    Each round points every node at its smallest neighbour, shortens these chains by pointer
    jumping until they end at local minima, and contracts the edges to those; at least half of the
    remaining nodes go each round. Tables are written between steps, joins are of two written
    tables, so a node with a third of all edges is split by the adaptive skew join.
    """
    pairs = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    rest, rounds = written(pairs, "edges"), []
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = written(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "parents")
        while True:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = written(parents.join(up, "root").select("node", F.col("up").alias("root"),
                                                             (F.col("up") != F.col("root")).alias("moved")), "parents")
            parents = jumped.select("node", "root")
            if jumped.where("moved").isEmpty():
                break
        rounds.append(parents)
        half = written(rest.join(parents.withColumnsRenamed({"node": "a", "root": "ra"}), "a").select("ra", "b"), "half")
        rest = written(half.join(parents.withColumnsRenamed({"node": "b", "root": "rb"}), "b")
                       .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
                       .where("a <> b").distinct(), "edges")
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[0].withColumnRenamed("root", "component")
    for later in rounds[1:]:
        step = later.select(F.col("node").alias("component"), F.col("root"))
        labels = written(labels.join(step, "component", "left")
                         .select("node", F.coalesce("root", "component").alias("component")), "labels")
    return labels
