"""Session defaults, the shared scratch folder, and tables kept there."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` entries win.

    Dots in configuration names are written as double underscores.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A fresh folder that every executor can reach.

    It lies below ``spark.checkpoint.dir``. Only a local master, where driver
    and executors share one disk, may fall back to the temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if shared:
        return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"snapstrata-{label}-")


def kept(table: DataFrame, label: str) -> DataFrame:
    """The table written to the scratch folder and read again, where it is used more than once.

    Every executor reaches the files, so a lost one costs only the tasks that it was running.
    """
    spark = table.sparkSession
    path = scratch_dir(spark, label)
    table.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.schema(table.schema).parquet(path)
