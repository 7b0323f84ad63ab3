"""Session set-up and the few session-wide helpers every operator shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_spark(app: str = "tallyforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for; extra ``conf`` wins."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores before costly work per row: shuffled only if its scan has fewer partitions than there are cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` to be broadcast if it has at most ``rows`` rows, which is counted; else it is joined by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which all executors share. Only a local session without one gets a temporary folder, removed at exit."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if spark.sparkContext.applicationId not in _LOCAL:
        made = _LOCAL[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="tallyforge-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
    return _LOCAL[spark.sparkContext.applicationId]


_LOCAL: dict[str, str] = {}


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder, so that lost executors cost no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table of its own in the shared folder and read back: columns and conditions still reach the scan."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
