"""Edge-list and vector sources.

An edge file is text: one edge per line, ``src<TAB>dst``, no header.
Lines starting with ``#`` are comments and blank lines are skipped.
Fields after the second are ignored; an empty field is the page with the
empty id.  A line with a single field is malformed: by default the read
fails on it, ``on_malformed="drop"`` drops it instead.  Table sources may
hold nulls at either end; ``on_null`` says whether such rows fail or go.

The reader is Spark's text source, so any number of files, globs and Hadoop
file-system URIs work and the scan is split across tasks.  A missing path
fails at read time (``PATH_NOT_FOUND``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ID_TYPES = ("string", "long")


def read_edges(
    spark: SparkSession,
    path: str | list[str],
    id_type: str = "string",
    on_malformed: str = "raise",
    report: Observation | None = None,
) -> DataFrame:
    """Read a tab-separated edge list into ``(src, dst)``.

    ``id_type="string"`` keeps ids as text ("01" and "1" are two pages);
    ``id_type="long"`` parses them as 64-bit integers (then they are one)
    and fails on text that is not a number.

    ``report`` counts in the same scan what was read and what was not: ``lines``,
    ``comments``, ``blanks``, ``malformed`` and ``edges``; its values are there after
    the first action that reads all edges, run in the session of ``spark``.
    """
    if id_type not in ID_TYPES:
        raise ValueError(f"id_type must be one of {ID_TYPES}, got {id_type!r}")
    if on_malformed not in ("raise", "drop"):
        raise ValueError("on_malformed must be 'raise' or 'drop'")
    lines = spark.read.text(path)
    blank, comment = F.col("value") == "", F.startswith("value", F.lit("#"))
    if report is not None:
        lines = lines.observe(report, *_counts(blank, comment))
    lines = lines.filter(~blank & ~comment)
    fields = lines.select("value", F.split("value", "\t").alias("f"))
    if on_malformed == "drop":
        edges = fields.filter(F.size("f") > 1).select(F.col("f")[0].alias("src"), F.col("f")[1].alias("dst"))
    else:
        one = F.raise_error(F.concat(F.lit("malformed edge line, one field: "), F.col("value")))
        edges = fields.select(
            F.col("f")[0].alias("src"), F.when(F.size("f") < 2, one).otherwise(F.get("f", F.lit(1))).alias("dst")
        )
    if id_type == "long":
        edges = edges.select(*[_to_long(c) for c in ("src", "dst")])
    return edges


def _counts(blank: Column, comment: Column) -> list[Column]:
    data = ~blank & ~comment
    separated = F.contains("value", F.lit("\t"))
    kinds = {"lines": F.lit(True), "comments": comment, "blanks": blank, "malformed": data & ~separated, "edges": data & separated}
    return [F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long").alias(k) for k, c in kinds.items()]


def _to_long(name: str):
    """Parse an id column to bigint, failing on text that is not a number.

    ``try_cast`` plus ``raise_error`` behaves the same whether or not the
    session runs in ANSI mode.
    """
    parsed = F.col(name).try_cast("long")
    return (
        F.when(
            F.col(name).isNotNull() & parsed.isNull(),
            F.raise_error(F.concat(F.lit(f"{name} is not a 64-bit integer: "), F.col(name))),
        )
        .otherwise(parsed)
        .alias(name)
    )


def complete_edges(edges: DataFrame, on_null: str = "raise", report: Observation | None = None) -> DataFrame:
    """``edges`` with both ends present: rows with a null end fail, or go with ``on_null="drop"``.

    ``report`` counts ``rows`` and those with a null end (``null_ends``) in the same scan.
    """
    if on_null not in ("raise", "drop"):
        raise ValueError("on_null must be 'raise' or 'drop'")
    missing = F.col("src").isNull() | F.col("dst").isNull()
    if report is not None:
        null_ends = F.coalesce(F.sum(F.when(missing, 1).otherwise(0)), F.lit(0)).cast("long").alias("null_ends")
        edges = edges.observe(report, F.count(F.lit(1)).alias("rows"), null_ends)
    if on_null == "drop":
        return edges.filter(~missing)
    ends = {c: F.when(missing, F.raise_error(F.lit("edge with a null end"))).otherwise(F.col(c)) for c in ("src", "dst")}
    return edges.withColumns({c: e.cast(edges.schema[c].dataType) for c, e in ends.items()})


def read_table_edges(
    spark: SparkSession, path: str, src: str = "src", dst: str = "dst", on_null: str = "raise"
) -> DataFrame:
    """Edges from a parquet table; only the two columns are read (pruned scan)."""
    edges = spark.read.parquet(path).select(F.col(src).alias("src"), F.col(dst).alias("dst"))
    return complete_edges(edges, on_null)


def read_vector(spark: SparkSession, path: str) -> DataFrame:
    """A rank vector ``(id, rank)`` saved earlier with ``write_ranks(fmt="parquet")`` (S3)."""
    return spark.read.parquet(path).select("id", F.col("rank").cast("double").alias("rank"))


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """A transition matrix ``(src, dst, w)`` saved earlier as parquet (S3)."""
    return spark.read.parquet(path).select("src", "dst", F.col("w").cast("double").alias("w"))
