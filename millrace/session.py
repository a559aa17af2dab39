"""Session helpers: a sensible local session and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Per application: the fallback scratch folder, and whether the package was shipped.
_own_folders: dict[str, str] = {}
_shipped: set[str] = set()
# Scratch paths handed out per application, for ``remove_scratch``.
_handed_out: dict[str, list[str]] = {}
# Tasks that a small scan is shared among at most.
SPREAD_TASKS = 64


def local_session(app: str = "millrace", cores: str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that every executor can reach.

    The cluster names that folder in ``spark.checkpoint.dir``.  Only a local
    session, where one machine holds all executors, may fall back to a folder of
    its own.
    """
    root = spark.conf.get(CHECKPOINT_KEY, None) or _own_folder(spark)
    path = f"{root.rstrip('/')}/millrace/{purpose}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application was handed so far; how many there were.

    Results that were not stored yet still read them, so this is for the end of a job.
    """
    paths = _handed_out.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    return sum(jvm.org.apache.hadoop.fs.Path(path).getFileSystem(conf).delete(jvm.org.apache.hadoop.fs.Path(path), True) for path in paths)


def _own_folder(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _own_folders[application]


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and hand back the stored table.

    Used where several results need the same intermediate: the stored table
    survives the loss of executors and is not recomputed.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Share a scan of few splits among the cores; leave any larger scan alone.

    A scan with fewer than ``SPREAD_TASKS`` splits holds at most that many times the split
    size, 8 GB by default, however many cores there are; with more nothing happens.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, SPREAD_TASKS)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def ship_package(spark: SparkSession) -> None:
    """Let Python tasks import this package wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        home = Path(__file__).resolve().parent
        base = f"{tempfile.mkdtemp(prefix='run-', dir='/tmp')}/{home.name}"
        context.addPyFile(shutil.make_archive(base, "zip", home.parent, home.name))
        _shipped.add(context.applicationId)
