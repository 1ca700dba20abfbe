"""Session helpers: scoped configuration, checkpoint folder, size budgets.

Nothing here changes a setting for good.  ``scoped_conf`` restores every
value it touched, and the checkpoint folder is taken from the session
(``spark.checkpoint.dir`` or ``SparkContext.setCheckpointDir``).  Without one, a
local-mode session gets a fresh folder under the system temp directory, and a
cluster session one in its warehouse, which its executors write to anyway.  On a
cluster a ``file:`` folder may be a shared mount or a machine's own: a small job
writes to it, and it is an error if the driver does not see what the executors wrote.
"""

from __future__ import annotations

import contextlib
import logging
import re
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sources import files

log = logging.getLogger(__name__)

_UNSET = object()
# (application, folder) of the folders that passed the test of ``_shared``
_SHARED: set[tuple[str, str]] = set()


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Set SQL confs for the duration of the block, then restore them."""
    saved = {}
    for key, value in settings.items():
        saved[key] = spark.conf.get(key, None) if spark.conf.isModifiable(key) else _UNSET
        if saved[key] is not _UNSET:
            spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, old in saved.items():
            if old is _UNSET:
                continue
            if old is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, old)


def child_session(spark: SparkSession) -> SparkSession:
    """A new session of the application with the present settings of ``spark``.

    Settings of the child do not reach ``spark`` or queries that run in it meanwhile.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if child.conf.isModifiable(key):
            child.conf.set(key, value)
    return child


def handed(df: DataFrame, to: SparkSession) -> DataFrame:
    """``df`` as a DataFrame of another session of the application, planned with that session's settings."""
    if df.sparkSession is to:
        return df
    name = f"surfrank_{uuid.uuid4().hex}"
    # a column more, for a while: dropping a view drops the cache of its very plan, which must stay
    df.withColumn(name, F.lit(0)).createOrReplaceGlobalTempView(name)
    try:
        return to.table(f"{to.conf.get('spark.sql.globalTempDatabase')}.{name}").drop(name)
    finally:
        to.catalog.dropGlobalTempView(name)


def is_local(spark: SparkSession) -> bool:
    """Whether the tasks run inside the driver (``local-cluster`` has executors of its own)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def _seen_by_all(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds all that the tasks of a small job wrote to ``folder``."""
    rows = 4 * spark.sparkContext.defaultParallelism
    path = f"{folder.rstrip('/')}/surfrank-probe-{uuid.uuid4().hex}"
    try:
        spark.range(0, rows, 1, rows).select(F.col("id").cast("string").alias("value")).write.text(path)
        return spark.read.text(path).count() == rows
    except Exception:  # an executor that cannot write there, or a file it cannot read
        log.warning("the folder %s failed its test", folder, exc_info=True)
        return False
    finally:
        files.remove(spark, path)


def _shared(spark: SparkSession, folder: str) -> str:
    """``folder``, unless it is a machine's own folder and the session runs on a cluster."""
    if not folder.startswith("file:") or is_local(spark):
        return folder
    known = (spark.sparkContext.applicationId, folder)
    if known not in _SHARED and not _seen_by_all(spark, folder):
        raise RuntimeError(f"checkpoint folder {folder} is on one machine; use one that every executor can reach")
    _SHARED.add(known)
    return folder


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints and written intermediate tables.

    Order: the folder already set on the context, then the
    ``spark.checkpoint.dir`` setting, then a new folder: a temporary one in
    local mode, else one in the warehouse.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
        if not configured and is_local(spark):
            configured = tempfile.mkdtemp(prefix="surfrank-ckpt-")
        sc.setCheckpointDir(configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_surfrank_checkpoints")
    return _shared(spark, sc.getCheckpointDir())


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def broadcast_budget(spark: SparkSession) -> int:
    """Byte budget for broadcasting a side: the session's own threshold.

    ``-1`` (broadcast disabled by the user) gives 0, so nothing is broadcast.
    """
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            value = int(float(raw[: -len(suffix)]) * units[suffix])
            break
    else:
        value = int(raw)
    return max(value, 0)


def checkpoint_file(df: DataFrame) -> str | None:
    """Folder of the reliable checkpoint a DataFrame reads from, if it is one."""
    try:
        opt = df._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
        return opt.get() if opt.isDefined() else None
    except Py4JError:  # not a checkpointed DataFrame
        return None


_TRACKED: list[DataFrame] = []


def tracked(df: DataFrame) -> DataFrame:
    """Remember a checkpointed DataFrame that an operator's result reads, for ``release_checkpoints``."""
    _TRACKED.append(df)
    return df


def release_checkpoints() -> None:
    """Delete the checkpoints behind results of ``vertex_index`` and ``rank_step``, which end with it."""
    while _TRACKED:
        drop_checkpoint(_TRACKED.pop())


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the checkpoint files behind ``df`` once nothing reads them any more.

    Spark only removes checkpoint files when ``spark.cleaner.referenceTracking.
    cleanCheckpoints`` is on; a loop that writes one vector per step would
    otherwise leave every step's vector behind in the shared folder.
    """
    path = checkpoint_file(df)
    if not path:
        return
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)
