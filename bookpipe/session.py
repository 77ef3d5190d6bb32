"""Session helpers: building one for local runs and cutting lineage safely."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter makes it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bookpipe")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        # Pages cost far more time than bytes: do not merge them into few tasks.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is accepted only where the whole job is one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="bookpipe-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


# Rows of a task that parses a page for each of them.
PAGES_A_TASK = 50_000


def tasks_for(df: DataFrame, rows: int = PAGES_A_TASK) -> int:
    """Tasks of at most about ``rows`` rows, at least one for each core."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))


def spread(df: DataFrame, *keys: str, rows: int | None = None) -> DataFrame:
    """Spread a scan over all cores if its files yield fewer splits than cores.

    For CPU-heavy steps after a scan. Large inputs have more splits than cores
    already and pass through without a shuffle, unless ``rows`` bounds the rows of a task:
    pages cost time by their number, and compressed splits hold millions.
    """
    tasks = df.sparkSession.sparkContext.defaultParallelism if rows is None else tasks_for(df, rows)
    if df.rdd.getNumPartitions() >= tasks:
        return df
    return df.repartition(tasks, *keys)
