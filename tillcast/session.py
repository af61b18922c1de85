"""Session helpers shared by tests, the bench and writing operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "tillcast") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


_LOCAL_FOLDERS: dict[str, str] = {}  # application id -> temporary folder, local masters only


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tillcast-")
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
