"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on.  All of them can be changed on a running
# session, so tune() also works on a session somebody else has built.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Partitions a shuffle begins with; adaptive execution joins small ones.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROWS_A_PARTITION = 250_000


def tune(spark: SparkSession) -> SparkSession:
    """Settings that the joins count on, and no others: the session may be somebody else's."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def make_room(spark: SparkSession, rows: int) -> SparkSession:
    """Let shuffles begin with partitions enough for a table of so many rows.

    With a fixed number of partitions tasks grow with the table until they spill.
    """
    have = int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if rows > have * ROWS_A_PARTITION:
        spark.conf.set(FIRST_PARTITIONS, str(-(-rows // ROWS_A_PARTITION)))
    return spark


def local_session(cores: int | str = "*", name: str = "everkey", **settings) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back on a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="everkey-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def spread(df: DataFrame) -> DataFrame:
    """Rows over as many tasks as a shuffle has, where the files of a small table would keep only a few busy."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder once and read it back.

    Cuts the lineage in a way that survives lost executors, and gives later
    joins exact sizes, column pruning and filter pushdown.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{scratch_root(spark)}/everkey/{app}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
