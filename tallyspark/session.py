"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: A lookup side is broadcast only if a count has shown that it has at most this many rows.
BROADCAST_ROWS = 200_000

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyspark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder every executor can reach.

    ``spark.checkpoint.dir`` wins; a temporary folder is used only by a local
    session that sets none, as in tests.  A cluster without the setting is refused:
    each of its executors would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="tallyspark-")
        configured = _local_dirs[app]
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{shared_dir(spark)}/tallyspark/{label}-{uuid.uuid4().hex}"


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executor loss."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder; cuts lineage and lets go of the shuffles behind it."""
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    del df
    let_go(spark)
    made = spark.read.schema(schema).parquet(path)
    _paths[made] = path
    return made


def let_go(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished plans, on a cluster.

    It does when the driver collects its garbage, which a driver with little to do may not do for long; asking for
    it keeps the disks free for what follows.
    """
    if not spark.sparkContext.master.startswith("local["):
        gc.collect()
        spark.sparkContext._jvm.System.gc()


#: Where the tables of ``written`` lie, as long as somebody holds them.
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def forget(made: DataFrame) -> None:
    """Delete the files of a table of ``written`` that no later plan reads."""
    if path := _paths.pop(made, None):
        session = made.sparkSession
        place = session._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table of narrow rows) marked for broadcast if it is counted to have at most ``rows`` rows."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
