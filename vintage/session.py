"""Session defaults and the shared folder that lineage cuts are written to."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vintage", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are designed for; ``conf`` overrides them."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="vintage-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def pin(df: DataFrame) -> DataFrame:
    """Fix ``df`` in reliable storage, so later reads see the same rows on the same partitions."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()
