"""Session settings and the shared folder for lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with AQE on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the session's own; with a local master, a temporary one where none is set (tests)."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="ledgerline-checkpoints-"))
    return context.getCheckpointDir()


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of intermediate data, wherever Spark keeps it; a missing folder is fine."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def listed(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, wherever Spark keeps it; none for a missing folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in files.listStatus(place)) if files.exists(place) else []


def cut_lineage(df: DataFrame) -> DataFrame:
    """``checkpoint()`` in the shared folder, so that a lost executor loses no result."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
