"""Session settings used by the tests, the benchmark and the command line."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from pageloom.plans.staging import LOCAL_FOLDER


def local_session(app: str = "pageloom", cpus: int | str = 8) -> SparkSession:
    """A local session.  On a cluster, submit the job and let it use the given one."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("PAGELOOM_DRIVER_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.checkpoint.dir", os.environ.get("PAGELOOM_CHECKPOINT_DIR", LOCAL_FOLDER))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
