"""Sinks: rank and edge writers (K1, K2).

Text output is ``id<TAB>rank``, one line per page, the format of the
original tool's result file.  ``ordered=True`` sorts by id with a range
partitioned sort, so the part files are in key order and no task holds
more than its range.  ``single_file=True`` writes the same part files in
parallel and lets the file system join them to the one file ``part-00000`` (HDFS
moves block references; no task gets the whole result).  Where the file system
cannot join files the call fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files

FORMATS = ("text", "parquet")


def write_ranks(
    ranks: DataFrame,
    path: str,
    fmt: str = "text",
    ordered: bool = False,
    single_file: bool = False,
    mode: str = "overwrite",
) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    if single_file and (fmt != "text" or mode != "overwrite"):
        raise ValueError("a single file is text and replaces what was there")
    out = ranks.select("id", "rank")
    if ordered:
        out = out.orderBy("id")
    if fmt == "parquet":
        out.write.mode(mode).parquet(path)
    else:
        _lines(out, "id", "rank").write.mode(mode).text(path)
    if single_file:
        _join(ranks.sparkSession, path)


def _join(spark: SparkSession, path: str) -> None:
    """One file ``part-00000`` of the part files in ``path``, in the order of their numbers."""
    parts = [n for n in files.names(spark, path) if n.startswith("part-")]
    files.concat(spark, path, parts, "joined")
    for name in files.names(spark, path):
        if name.startswith(("part-", ".part-")):
            files.remove(spark, f"{path}/{name}")
    files.rename(spark, f"{path}/joined", f"{path}/part-00000")


def write_edges(edges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Edge list as the reader expects it: ``src<TAB>dst`` lines, written verbatim."""
    _lines(edges, "src", "dst").write.mode(mode).text(path)


def _lines(df: DataFrame, first: str, second: str) -> DataFrame:
    # plain text lines: no quoting or escaping, so a value is written as is
    # (a CSV writer would guard a leading comment character)
    return df.select(
        F.concat_ws("\t", F.col(first).cast("string"), F.col(second).cast("string")).alias("value")
    )
