"""Session construction and the shared checkpoint folder.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are still unset, so cluster values always win.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Defaults for local runs and tests; a cluster session keeps its own values.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Return the active session, or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    master = master or os.environ.get("TESSERA_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    Reads ``spark.checkpoint.dir`` from the session (set by the cluster to a
    shared file system). Only when it is unset in a one-process ``local``
    session (tests) a fresh temporary folder is created and registered; a
    cluster without the setting gets an error instead of a machine-local path.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc = spark.sparkContext
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


_SHIPPED = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per application, so that
    functions pickled by reference import there too."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-zip-"), "tessera.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("tessera", os.path.relpath(path, root)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def reliable_checkpoint(df):
    """``DataFrame.checkpoint`` into the shared folder (never localCheckpoint)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Rows a file of a table that model fits scan many times: adaptive execution
# sizes tasks by bytes, so a million narrow rows would else be one task's work.
FIT_ROWS = 50_000


def written(df, name: str, rows_each: int = 0):
    """``df`` written as Parquet into the shared folder and read back: it is
    computed once, lineage ends there, and nothing stays in executor memory.
    With ``rows_each`` no file holds more rows, so that readers share them out."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tessera-{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", rows_each).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
