"""Column expressions and session helpers shared by the corpus operators."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, scoped_conf

#: Characters that separate words: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
#: Folder below the shared one for intermediate tables.
SCRATCH = "surfrank-corpus"
#: A word, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{SCRATCH}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut", batch: int | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, survives lost executors.

    The write's own shuffle files go when it ends; nothing reads them again.
    ``batch``: rows that a Python worker gets at once.
    """
    path = scratch_path(df.sparkSession, name)
    conf = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch:
        conf["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch)
    with scoped_conf(df.sparkSession, conf):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete all written intermediate tables; results that still read them end with it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{SCRATCH}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def without_spaces(text: Column) -> Column:
    out = text
    for c in SPACES:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def plain_names(df: DataFrame, *names: str) -> tuple[DataFrame, list[Column]]:
    """``df`` with columns c0, c1, ..., which no name used inside an operator equals, and those that were ``names``.

    ``toDF(*df.columns)`` gives the names back, also if some are equal but for case.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain, [F.col(f"c{df.columns.index(n)}") for n in names]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once for each application.

    Spark itself hands the archive to every executor, also to later ones.
    """
    sc = spark.sparkContext
    name = f"{__name__.partition('.')[0]}.zip"
    if not any(os.path.basename(f) == name for f in sc.listFiles):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        at = os.path.join(tempfile.mkdtemp(), name)
        shutil.make_archive(at.removesuffix(".zip"), "zip", os.path.dirname(package), os.path.basename(package))
        sc.addPyFile(at)
