"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on; sizing settings stay with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", app: str = "pulselake") -> SparkSession:
    """A session for tests and benches on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables and stream checkpoints of one run.

    Lives under ``spark.checkpoint.dir``, the folder every executor can reach. Only a local
    session without that setting may fall back to a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/pulselake/{label}-{uuid.uuid4().hex[:12]}"


def side_by_side(run: Callable, items: Iterable) -> list:
    """Run a few independent Spark jobs at the same time, so the tail of one does not idle the cluster."""
    items = list(items)
    with ThreadPoolExecutor(max_workers=max(len(items), 1)) as pool:
        return list(pool.map(run, items))
