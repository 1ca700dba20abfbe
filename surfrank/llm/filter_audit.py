"""Filter interaction audit: what each filter removes, wherever it stands in the order.

Every filter has a relation of the rows that fail it (one written table per
filter).  What a filter removes after others depends only on the set of those
others.  So the union of all relations goes through one left-anti join per
filter, in which each row goes on both without that filter and, if it survives
it, with it: what arrives are the rows that survive each set of filters and fail
another one.  Label losses are the same rows, left-semi joined with the labelled
ids first.  Counts of these by set (2^n - 1 per part and measure, 31 for five
filters) give every one of the n! orders.

Work: one pass over the texts makes numbers and flags, written once with a row
number.  Failing-id relations are narrow, each is exchanged by row number once;
the copies of a row, 2^(n - 1) at most, stay in their partition and are counted
there.  Rows of repeated texts are found by the
SHA-256 of the whole text: smallest id by digest (partial aggregation, so a large
group of copies costs a row per task), joined back to the rows.  The report has
parts * n! * n rows; the list of orders (120 for five) is a literal.

Cases: null text and part are ''; a row with a null id never fails the repeat
filter and has no label; rows with the same id and text are no copies of a
smaller id, so all pass; repeated label rows count once; an empty table gives an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut

#: The count of rows that a filter removes; labels add their own.
REMOVED = "removed"


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters A to D on a text without null."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"))
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return {
        "A": n < 50,
        "B": 100 * distinct < 65 * n,
        "C": 100 * capitals > 5 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failing(docs: DataFrame, filters: Mapping[str, Column], repeats: str | None, id_col: str, text_col: str, part_col: str):
    """The rows (row, id, part) of ``docs``, and for each filter the table of those that fail it.

    ``filters`` are conditions over the column ``text``; ``repeats`` names the
    filter that a row fails if a smaller id has the same text.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    flags = [F.coalesce(c, F.lit(False)).alias(f"fails_{k}") for k, c in filters.items()]
    digest = [F.unhex(F.sha2("text", 256)).alias("digest")] if repeats else []
    facts = cut(rows.select(F.monotonically_increasing_id().alias("row"), "id", "part", *digest, *flags), "facts")
    tables = {k: facts.filter(f"fails_{k}") for k in filters}
    if repeats:
        first = facts.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1")
        tables[repeats] = facts.join(first, "digest").filter("id > first")
    return facts, {k: cut(t.select("row", "id", "part"), f"fails-{k}") for k, t in sorted(tables.items())}


def removals(tables: Mapping[str, DataFrame], labels: Mapping[str, DataFrame]) -> DataFrame:
    """(prefix, part, filter, removed, a column for each label): rows that a filter removes from the survivors of ``prefix``.

    ``prefix`` is a set of filters, written in ascending order.
    """
    failed = reduce(DataFrame.unionByName, [t.withColumn("filter", F.lit(k)) for k, t in tables.items()])
    losses = [failed.join(ids.select("id"), "id", "left_semi").withColumn("measure", F.lit(k)) for k, ids in labels.items()]
    # one written relation: the optimizer would push each anti join below each part of the union
    measured = cut(
        reduce(DataFrame.unionByName, losses, failed.withColumn("measure", F.lit(REMOVED))).select("row", "part", "filter", "measure"),
        "measured",
    )
    left = measured.withColumn("prefix", F.lit(""))
    for k in sorted(tables):  # each row goes on without the filter, and with it if it survives
        tried = left.withColumn("applied", F.explode(F.array(F.lit(False), F.lit(True))))
        gone = tables[k].select(F.col("row").alias("gone"))
        left = tried.join(gone, (F.col("row") == F.col("gone")) & F.col("applied"), "left_anti").select(
            "row", "part", "filter", "measure", F.when(F.col("applied"), F.concat("prefix", F.lit(k))).otherwise(F.col("prefix")).alias("prefix")
        )
    of = cut(left.groupBy("prefix", "part", "filter", "measure").count(), "removals")
    sums = [F.coalesce(F.sum(F.when(F.col("measure") == k, F.col("count"))), F.lit(0)).alias(k) for k in (REMOVED, *labels)]
    return of.groupBy("prefix", "part", "filter").agg(*sums)


def audit(
    docs: DataFrame,
    filters: Mapping[str, Column],
    labels: Mapping[str, DataFrame],
    repeats: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """One row per part, order of the filters and step.

    ``filters``: failure conditions over a column ``text`` by one-letter name.
    ``labels``: tables of ids (``id``) by the name of their loss column.
    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    shapley (the filter's removals summed over all orders) and the losses.
    """
    facts, tables = failing(docs, filters, repeats, id_col, text_col, part_col)
    orders = ["".join(p) for p in permutations(sorted(tables))]
    steps = (
        facts.groupBy("part")
        .agg(F.count("*").alias("total"))
        .withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .select("part", "total", "filter_order", F.posexplode(F.split("filter_order", "")).alias("at", "filter"))
        .withColumn("prefix", F.array_join(F.array_sort(F.split(F.expr("left(filter_order, at)"), "")), ""))
    )
    told = steps.join(removals(tables, labels), ["prefix", "part", "filter"], "left").na.fill(0, [REMOVED, *labels])
    filtered = Window.partitionBy("part", "filter")
    so_far = Window.partitionBy("part", "filter_order").orderBy("at")
    last = len(tables) - 1
    fails = F.max(F.when(F.col("at") == 0, F.col(REMOVED))).over(filtered)  # nothing is removed before the first step
    alone = F.max(F.when(F.col("at") == last, F.col(REMOVED))).over(filtered)  # all others have been applied
    return told.select(
        "part",
        "filter_order",
        (F.col("at") + 1).cast("int").alias("step"),
        (F.col("total") - F.sum(REMOVED).over(so_far)).alias("kept"),
        REMOVED,
        (fails - F.col(REMOVED)).alias("redundant"),
        alone.alias("unique_fails"),
        F.sum(REMOVED).over(filtered).alias("shapley"),
        *labels,
    )


def label_ids(labels: DataFrame, condition: str, id_col: str = "doc_id") -> DataFrame:
    return labels.filter(condition).select(F.col(id_col).alias("id"))


ORACLE_SQL = r"""
with f as (
  select coalesce(source, '') as part, doc_id, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x != '') as w,
         min(doc_id) over (partition by coalesce(text, '')) as first
  from documents
), m as (
  select part, (coalesce(len(w), 0) < 50)::int as a,
         (100 * len(list_distinct(w)) < 65 * len(w))::int as b,
         (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::int as c,
         regexp_matches(t, '[#$%&*|]')::int as d,
         coalesce(doc_id > first, false)::int as e,
         coalesce(doc_id in (select doc_id from labels where quality = 1), false) as good,
         coalesce(doc_id in (select doc_id from labels where toxic = 1), false) as toxic
  from f
), k as (
  select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, count(*) as n,
         count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from m group by all
), l as (
  select unnest(['A', 'B', 'C', 'D', 'E']) as x, unnest([1, 2, 4, 8, 16]) as bit
), o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from l a, l b, l c, l d, l e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s as (
  select filter_order, step, bits[step] as bit, coalesce(list_sum(bits[1:step - 1]), 0)::bigint as before
  from o, (select unnest([1, 2, 3, 4, 5]) as step)
), r as (
  select part, filter_order, step, bit,
         coalesce(sum(n) filter (mask & (before | bit) = 0), 0)::bigint as kept,
         coalesce(sum(n) filter (mask & bit != 0 and mask & before = 0), 0)::bigint as removed,
         coalesce(sum(n) filter (mask & bit != 0 and mask & before != 0), 0)::bigint as redundant,
         coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (mask & bit != 0 and mask & before = 0), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (mask & bit != 0 and mask & before = 0), 0)::bigint as toxic_lost
  from k, s group by all
)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from r
"""
