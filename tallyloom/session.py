"""Session helpers: a local session for tests and benchmarks, and the shared working folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session. Cluster jobs bring their own session and settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


_OWN_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Executors come and go, so anything that cuts lineage must sit where all of them can read it.
    Only a local session that names no folder gets one of its own.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if context.applicationId not in _OWN_ROOTS:
        _OWN_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tallyloom-")
    return _OWN_ROOTS[context.applicationId]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, never reused folder below the shared root."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back, for results that are used repeatedly."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Have the driver collect its garbage: shuffle files of finished steps go only then, and with a roomy heap that may be never."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_STAGED: dict[tuple[str, ...], tuple[str, object]] = {}


def is_staged(spark: SparkSession, label: str, source: str) -> bool:
    return (spark.sparkContext.applicationId, label, source) in _STAGED


def staged(spark: SparkSession, label: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived table that many queries of one application read: written once, then read back."""
    key = (spark.sparkContext.applicationId, label, source)
    if not is_staged(spark, label, source):
        df = build()
        path = fresh_folder(spark, label)
        df.write.parquet(path)
        _STAGED[key] = (path, df.schema)
    path, schema = _STAGED[key]
    return spark.read.schema(schema).parquet(path)

