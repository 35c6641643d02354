"""Session settings the library relies on, and where it may write working data."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Days and instants are UTC, bad casts fail loudly, partition values stay text,
# element names of documents are told apart by letter case.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.caseSensitive": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", **extra: str) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("wattline")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def work_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder for written intermediate data.

    It lies in the shared folder named by ``spark.checkpoint.dir``. Only a local
    session, which has no executors elsewhere, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="wattline-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
