"""Session set-up and the shared folder for checkpoints and written tables."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app="tidecast", cpus=8, **conf):
    """A local session for tests and the bench; a cluster brings its own.

    Memory is the caller's choice (``spark.driver.memory`` among ``conf``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def reach_workers(spark):
    """Let Python workers that see this folder import the package.

    Workers on other machines get it with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def shared_dir(spark):
    """The folder of ``spark.checkpoint.dir``, with checkpointing switched on.

    Every executor has to see it, so it is only made up for a local master.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tidecast-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark, label):
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
