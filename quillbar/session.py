"""Session helpers: a builder with sensible defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "quillbar", master: str | None = None, **conf) -> SparkSession:
    """A session with AQE on and UTC as the session zone. Extra settings: ``**{"spark.driver.memory": "8g"}``."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, where every executor can read and write.

    A machine-local folder is used only when the setting is absent and the master is local.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quillbar-", dir="/tmp")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
