"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes of rows that a Python worker gets at once, where `bound_batches` was called.
BATCH_BYTES = 4 << 20

_LOCAL_DIRS: dict[str, str] = {}
_STORED: dict[str, list[str]] = {}


def session(app: str = "fieldcatch", **conf: str) -> SparkSession:
    """A session with the settings the library is written for; `conf` adds or overrides."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="fieldcatch-")
    return _LOCAL_DIRS[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has been written to yet; `drop_stored` knows it."""
    path = os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stored_paths(spark: SparkSession) -> set[str]:
    """What this application has written to the shared folder and not deleted."""
    return set(_STORED.get(spark.sparkContext.applicationId, []))


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    What is read back no longer depends on the executors that computed it, and later readers
    still prune columns and push filters into the files. Its size is known when a join is planned, so a small side
    is broadcast at once; of one that is only computed Spark learns it when the other side has been shuffled.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver's as a table. As an Arrow table they need no Python workers to be unpickled,
    which would be a pool of their own beside those of the operators."""
    kind = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.table({name: [r[i] for r in rows] for i, name in enumerate(kind.names)}), kind)


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """From here on Python workers get at most about `most` bytes of rows at once. The session's own smaller bound stays.

    Of long texts, the usual 10,000 rows take tens of MB, several times over, in the worker and in the JVM beside it.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < held <= most:
        spark.conf.set(key, most)


def drop_stored(spark: SparkSession, keep: set[str] = frozenset()) -> int:
    """Delete what this application wrote to the shared folder, but for `keep`, once results are out.

    Frames built on it can no longer be read. Returns the number of paths deleted.
    """
    app = spark.sparkContext.applicationId
    paths = [p for p in _STORED.get(app, []) if p not in keep]
    _STORED[app] = [p for p in _STORED.get(app, []) if p in keep]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in map(hadoop.Path, paths):
        path.getFileSystem(conf).delete(path, True)
    return len(paths)
