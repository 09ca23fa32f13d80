"""Session defaults and the one place that knows where shared intermediate data go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # files of a checkpoint go when nothing refers to it any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int = 8, memory: str = "8g", app: str = "quarrylamp", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app).config("spark.driver.memory", memory)
    b = b.config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.showConsoleProgress", "false")
    for k, v in {**DEFAULTS, **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate data that all executors see: the one the cluster names in ``spark.checkpoint.dir``.

    Where it is unset, a session on one machine (tests, the bench) gets a folder below its ``spark.local.dir``; any
    other session raises, since a machine's own folder can't be read from another machine.
    """
    conf = spark.sparkContext.getConf()
    if named := conf.get("spark.checkpoint.dir"):
        return named
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{conf.get('spark.local.dir', '/tmp')}/quarrylamp-{spark.sparkContext.applicationId}"


def fresh_folder(spark: SparkSession) -> str:
    """A new folder below the shared one."""
    return f"{shared_folder(spark)}/quarrylamp-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """`df`, computed once, stored in the shared folder and read from there. Never a local checkpoint: its blocks die
    with their executor. A cluster that sets spark.cleaner.referenceTracking.cleanCheckpoints frees the files."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """`df` over at least as many tasks as there are cores, for work that costs far more than moving the rows.

    Only a scan of a few files is moved: it has fewer partitions than cores. A scan of many files, and any plan that
    shuffles already, comes back as it is.
    """
    if "Adaptive" in df._jdf.queryExecution().executedPlan().nodeName():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
