"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own settings."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabwright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def local_folder(spark: SparkSession, prefix: str) -> str:
    """A scratch folder of this machine, which only a local session may use."""
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=prefix)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df``.

    The folder is the shared one named in ``spark.checkpoint.dir``; a scratch
    folder is used only by a local session that names none (tests).
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(shared or local_folder(df.sparkSession, "tabwright-ckpt-"))
    return df.checkpoint(eager=True)
