"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Two texts are equal when they are identical after deleting the characters
space and U+0009 to U+000D; null counts as empty.  Of equal texts the row
with the most code points stays, then the smallest doc_id (null last), then
any one row.

One scan reduces a text to numbers (lengths, hash of a prefix, SHA-256);
those narrow rows are checkpointed and refined: only rows whose length
occurs twice are grouped by prefix hash, only rows whose prefix hash occurs
twice by the full hash.  Groups are aggregated before the shuffle and the
rows of a group are never collected.  The full hash is taken in the scan
already, as it is part of the result for every row.

Cases: an empty table gives an empty result; null and blank texts are one
group; repeated rows form a group of which one row is kept; extra columns
are ignored (``decide``) or carried along (``keep_first``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, plain_names, without_spaces

PREFIX = 64


def _facts(text: Column, prefix: int) -> dict[str, Column]:
    raw = F.coalesce(text, F.lit(""))
    norm = without_spaces(raw)
    return {
        "_chars": F.char_length(raw),
        "_len": F.char_length(norm),
        "_prefix": F.xxhash64(F.substring(norm, 1, prefix)),
        "_sha": F.sha2(norm, 256),
    }


def _groups(facts: DataFrame, order: Column) -> DataFrame:
    """One row for each group of two rows or more: keys, size, first row in ``order``."""
    by_len = facts.groupBy("_len").count().filter("count > 1").select("_len")
    left = facts.join(by_len, "_len", "left_semi")
    by_prefix = left.groupBy("_len", "_prefix").count().filter("count > 1").select("_len", "_prefix")
    left = left.join(by_prefix, ["_len", "_prefix"], "left_semi")
    return (
        left.groupBy("_len", "_prefix", "_sha")
        .agg(F.count("*").alias("_size"), F.min(order).alias("_first"))
        .filter("_size > 1")
    )


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256."""
    facts = cut(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .withColumns(_facts(F.col("_text"), prefix))
        .select("_id", "_chars", "_len", "_prefix", "_sha", F.monotonically_increasing_id().alias("_row"))
    )
    groups = _groups(
        facts,
        F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("id"), F.col("_row").alias("row")),
    )
    return facts.join(groups, ["_len", "_prefix", "_sha"], "left").select(
        F.col("_id").alias("doc_id"),
        F.when(F.col("_first").isNull(), F.col("_id")).otherwise(F.col("_first.id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_first.row") == F.col("_row"), F.lit(True)).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX) -> DataFrame:
    """``docs`` without the rows that ``decide`` drops; same columns.

    Rows that agree in id, code points and normalised text are one until the
    last step, which keeps one of them.
    """
    plain, (given, text) = plain_names(docs, id_col, text_col)
    marked = plain.withColumns(_facts(text, prefix)).withColumn("_id", given)
    facts = cut(marked.select("_id", "_chars", "_len", "_prefix", "_sha"))
    groups = _groups(facts, F.struct((-F.col("_chars")).alias("c"), F.col("_id").isNull().alias("n"), F.col("_id").alias("id")))
    gone = (
        facts.distinct()
        .join(groups.select("_len", "_prefix", "_sha", "_first"), ["_len", "_prefix", "_sha"])
        .filter(~(F.col("_id").eqNullSafe(F.col("_first.id")) & (F.col("_chars") == -F.col("_first.c"))))
        .select(F.col("_id").alias("_gid"), F.col("_chars").alias("_gchars"), F.col("_sha").alias("_gsha"))
    )
    rest = marked.join(
        gone,
        F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_chars") == F.col("_gchars")) & (F.col("_sha") == F.col("_gsha")),
        "left_anti",
    )
    return rest.dropDuplicates(["_id", "_chars", "_sha"]).select(*plain.columns).toDF(*docs.columns)


ORACLE_SQL = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents
), r as (
  select *, count(*) over (partition by norm) as group_size,
         first_value(doc_id) over (partition by norm order by chars desc, doc_id) as keep_id
  from t
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from r
"""
