"""Session helpers: building a session for tests/bench and finding the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "tessera",
              shuffle_partitions: int | None = None) -> SparkSession:
    """A session with AQE on and the UI off.

    On a cluster the session is normally created by the launcher; this helper
    only fills in settings that are still unset.
    """
    master = master or os.environ.get("TESSERA_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master.startswith("local"):
        # local mode: the driver JVM is the only executor; 1 GB default heap
        # turns long runs into garbage collection
        builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A folder of this machine is set only
    in local mode (tests, laptops) when the session has none: on a cluster the
    executors would each write to their own disk, so there it is an error."""
    sc = spark.sparkContext
    ship_package(spark)  # whoever asks for the folder may run functions of this package on the executors
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors (once per context): functions that
    run in Arrow batches import it there, whatever folder the driver started in."""
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="tessera-package-")  # served to the executors until the driver ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    target = os.path.join(folder, "tessera_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for at, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    z.write(path, os.path.join("tessera", os.path.relpath(path, root)))
    sc.addPyFile(target)
    sc._tessera_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor
    loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table under the shared checkpoint folder and
    read it back: cuts the lineage like ``checkpoint`` but stores columnar,
    compressed files, and the re-read table carries size statistics for AQE."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables written by ``materialize`` that no later job
    reads, so that the shared folder holds only what is still needed."""
    for df in tables:
        files = df.inputFiles()
        if files:
            jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
            path = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            path.getFileSystem(conf).delete(path, True)
