"""Spark session and shared-folder helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every session of this library should carry.  AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splitting is what keeps a
# hot basket or customer from landing in a single task.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where the join's partitioning is used further up: a skewed join is worth one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "tillroll",
                  shuffle_partitions: int | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, *, allow_local_default: bool = False) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (it has to be visible to every
    executor).  Where all of Spark runs on this machine (tests, benches),
    ``allow_local_default=True`` gives a fresh scratch folder when the setting is absent.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not (allow_local_default and spark.conf.get("spark.master", "").startswith("local")):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        path = tempfile.mkdtemp(prefix="tillroll-ckpt-")
    return path


def run_folder(spark: SparkSession, purpose: str, *, allow_local_default: bool = False) -> str:
    """A new, uniquely named folder under the shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark, allow_local_default=allow_local_default).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
