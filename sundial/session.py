"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Tasks over which rows are dealt by a key, if the session asks for no more.
KEY_PARTS = 256


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        # call-site capture makes building plans with hundreds of columns slow
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute a shared intermediate once, in the checkpoint folder the cluster names.

    The data outlives a lost executor because it is on shared storage. Without such a folder the
    table is only kept in memory and on disk, and lost parts are computed again.
    """
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist()
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def dealt_by_key(df: DataFrame, *keys: str, parts: int = KEY_PARTS) -> DataFrame:
    """Rows of a key together, over many tasks, before windows or wide aggregates on the key.

    Adaptive execution joins the parts of a shuffle until their compressed bytes fill a task, but sort buffers and aggregates of
    hundreds of columns take many times that in memory. A number of parts that is asked for is kept.
    """
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *keys)
