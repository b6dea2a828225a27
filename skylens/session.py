"""Session helpers: settings that the operators rely on, and a checkpoint folder.

Library code never creates a machine-local folder when it runs on a cluster: the
checkpoint directory comes from ``spark.checkpoint.dir`` set by the cluster; only
tests and local runs fall back to a fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

JIT_LIMIT = 8000
PART_BYTES = 8 << 20

# Settings every skylens job expects; all are runtime (session) settings.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "skylens", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster use the cluster's own builder and call ``configure``."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for key, value in {**SESSION_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply runtime defaults without overriding anything the cluster already chose."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster; a temp folder only when unset (tests)."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return spark.sparkContext.getCheckpointDir() or configured
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="skylens-checkpoint-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def in_parts(spark: SparkSession) -> SparkSession:
    """``spark`` set to compile a stage as one method only where the JVM compiles that in turn: HotSpot never does
    beyond 8,000 bytes of code, and wide stages (validation, decoding) then ran in its interpreter. Such stages take
    seconds for few bytes, so what they read isn't merged into about as many tasks as there are cores, of which the last few run alone."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > JIT_LIMIT:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(JIT_LIMIT))
    if spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("64MB", "67108864b"):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PART_BYTES))
    return spark


def written(df, tag: str):
    """``df`` written as Parquet to the shared checkpoint folder and read back: a cut in the lineage
    that survives lost executors. Hexadecimal ids are most of many tables, and zstd halves them."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
