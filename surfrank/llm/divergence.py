"""Source divergence audit: which sources of a language use its words differently, and which words.

Terms are runs of letters ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` (every character above
U+007F counts as one), A-Z lower-cased.  A language keeps its V terms that
``min_docs`` of its documents have.  A group is a (language, source), and so is a
whole language; each gives every kept term
``p = 1 + floor(10^9 * (count + 5) / (N + 5 * V))`` with N the group's count of
kept terms, in whole numbers throughout.

Method, run-length columns.  The vocabulary is put in an order that brings terms
of equal counts together: by language, then the language's count, then a hash of
the counts in all sources, so terms with the same counts everywhere are
neighbours.  A source's column of counts is then cut into blocks of ``BLOCK``
places and run-length encoded, runs of zero included.  For two sources the
boundaries of their runs are intersected and ``|p - q|`` is multiplied by the
length of each piece; a pair costs its runs, not V.

Work and bounds: the text is counted in one pass (tables of at most ``HELD``
terms in a worker, summed by Spark).  The order is a range-partitioned sort, no
task holds a language.  A column block has at most ``BLOCK`` runs.  Pairs are
compared in tiles of about ``TILE`` sources by ``TILE`` for each block, so a task
holds ``2 * TILE`` column blocks.  Every pair of sources is in the result, so the
pairs themselves are the size of the result.  Numbers are exact while 5 * V + N
and V * 10^9 stay below 2^63.

Cases: null text, language and source are ''; a language without kept terms
(V = 0) has value 0 for each pair and no ``term`` rows; a source without terms is
a group with N = 0; a language with one source has no ``pair`` rows; an empty
table gives an empty result; repeated rows count as often as they occur; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, ship

SCALE = 1_000_000_000
BLOCK = 8192
TILE = 128
#: Terms that a worker holds before it hands its counts on.
HELD = 200_000
#: Bytes of a text that are split into words at once.
PIECE = 1 << 20

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def _words(text: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        if end < len(text):
            gap = text.rfind(b" ", at + 1, end + 1)
            if gap < 0:  # a word longer than a piece stays whole
                gap = text.find(b" ", end)
            end = gap if gap >= 0 else len(text)
        yield text[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term by language and source; a row without a term tells that a group occurs."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def told() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.record_batch(
                [
                    pa.array([lang] * (len(terms) + 1), pa.string()),
                    pa.array([source] * (len(terms) + 1), pa.string()),
                    pa.array([*(t.decode() for t in terms), None], pa.string()),
                    pa.array([*n.values(), 0], pa.int64()),
                    pa.array([*(docs[t] for t in terms), 0], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    for batch in batches:
        lang, source, text = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            n, docs = held.setdefault((lang[i].as_py(), source[i].as_py()), (Counter(), Counter()))
            seen: set[bytes] = set()
            for words in _words((text[i].as_py() or b"").translate(_LETTERS)):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            if i % 64 == 0 and sum(len(c) for c, _ in held.values()) > HELD:
                yield from told()
    yield from told()


def share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(10^9 * (count + 5) / (total + 5 * kept))``, exact."""
    top = f"cast({SCALE} as decimal(10, 0)) * cast({count} + 5 as decimal(19, 0))"
    return F.expr(f"case when {kept} > 0 then 1 + ({top}) div cast({total} + 5 * {kept} as decimal(19, 0)) end")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, docs), and for each group a row with term null."""
    ship(docs.sparkSession)
    lang, source = (F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source")))
    raw = docs.select(lang, source, F.col(text_col).cast("binary").alias("text")).mapInArrow(_count, _COUNTS)
    return raw.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(counts: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, lang_n, pos): kept terms in the order that clusters equal counts."""
    kept = (
        counts.filter("term is not null")
        .groupBy("lang", "term")
        .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"), F.bit_xor(F.xxhash64("source", "n")).alias("shape"))
        .filter(F.col("docs") >= min_docs)
    )
    order = ["lang", "lang_n", "shape", "term"]
    ranged = kept.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut(ranged.select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("pos")), "vocabulary")


def columns(cells: DataFrame, groups: DataFrame, vocab: DataFrame) -> DataFrame:
    """(lang, source, block, places, rest, runs): a source's run-length column in one block.

    ``runs`` are (start, length, p) of the terms that the source has, ``rest`` is p of the others.
    """
    block = F.shiftright("pos", BLOCK.bit_length() - 1)
    blocks = vocab.groupBy("lang", block.alias("block")).agg(F.min("pos").alias("first"), F.count("*").alias("places"))
    alike = Window.partitionBy("lang", "source", "block", "n").orderBy("pos")
    runs = (
        cells.withColumn("block", block)
        .withColumn("island", F.col("pos") - F.row_number().over(alike))
        .groupBy("lang", "source", "block", "n", "island")
        .agg(F.min("pos").alias("start"), F.count("*").alias("length"))
    )
    sets = (
        runs.join(groups.select("lang", "source", "total", "kept"), ["lang", "source"])
        .groupBy("lang", "source", "block")
        .agg(F.collect_list(F.struct("start", "length", share("n", "total", "kept").alias("p"))).alias("runs"))
    )
    whole = groups.filter("kept > 0").join(blocks, "lang")
    return whole.join(sets, ["lang", "source", "block"], "left").select(
        "lang", "source", "tile", "tiles", "block", "places", share("0", "total", "kept").alias("rest"),
        F.transform("runs", lambda r: F.struct((r["start"] - F.col("first")).alias("start"), r["length"], r["p"])).alias("runs"),
    )


def _steps(places: int, rest: int, runs: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Ends and values of the runs that cover 0 to ``places``, gaps filled with ``rest``."""
    ends, values, at = [], [], 0
    for run in sorted(runs or (), key=lambda r: r["start"]):
        if run["start"] > at:
            ends.append(run["start"])
            values.append(rest)
        at = run["start"] + run["length"]
        ends.append(at)
        values.append(run["p"])
    if at < places:
        ends.append(places)
        values.append(rest)
    return np.array(ends, np.int64), np.array(values, np.int64)


def _pairs(group: pa.Table) -> pa.Table:
    """Sums of |p - q| over one block, for the pairs of sources of two tiles."""
    rows = group.to_pylist()
    held = [(r["source"], r["tile"], *_steps(r["places"], r["rest"], r["runs"])) for r in rows]
    a, b = rows[0]["a"], rows[0]["b"]
    out: tuple[list, list, list] = ([], [], [])
    for one, tile, ends, values in held:
        if tile != a:
            continue
        for other, beside, more, q in held:
            if beside != b or (a == b and one >= other):
                continue
            cuts = np.union1d(ends, more)
            apart = np.abs(values[np.searchsorted(ends, cuts)] - q[np.searchsorted(more, cuts)])
            for column, value in zip(out, (one, other, int((apart * np.diff(cuts, prepend=0)).sum())), strict=True):
                column.append(value)
    lang = pa.array([rows[0]["lang"]] * len(out[0]), pa.string())
    return pa.table([lang, *(pa.array(c, k) for c, k in zip(out, (pa.string(), pa.string(), pa.int64()), strict=True))], names=["lang", "one", "other", "part"])


def pair_values(cells: DataFrame, groups: DataFrame, vocab: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language, both ways."""
    of = columns(cells, groups, vocab).withColumn("beside", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    tiled = of.withColumns({"a": F.least("tile", "beside"), "b": F.greatest("tile", "beside")}).drop("beside", "tiles")
    sums = (
        tiled.groupBy("lang", "block", "a", "b")
        .applyInArrow(_pairs, "lang string, one string, other string, part long")
        .groupBy("lang", "one", "other")
        .agg(F.sum("part").alias("value"))
    )
    both = sums.withColumn("ends", F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item")))))
    bare = groups.filter("kept = 0").select("lang", "source")  # languages that keep no term
    zero = bare.join(bare.select("lang", F.col("source").alias("item")), "lang").filter("source != item")
    return both.select("lang", "ends.source", "ends.item", "value").unionByName(zero.withColumn("value", F.lit(0).cast("long")))


def term_values(cells: DataFrame, groups: DataFrame, langs: DataFrame) -> DataFrame:
    """(lang, source, item, value) for the terms that a source has and uses more than its language."""
    return (
        cells.join(groups.select("lang", "source", "total", "kept"), ["lang", "source"])
        .join(langs.select("lang", "lang_total"), "lang")
        .select(
            "lang", "source", F.col("term").alias("item"),
            (share("n", "total", "kept") - share("lang_n", "lang_total", "kept")).alias("value"),
        )
        .filter("value > 0")
    )


def audit(
    docs: DataFrame,
    min_docs: int = 30,
    top: int = 50,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank; see the module's docstring."""
    counts = cut(term_counts(docs, text_col, lang_col, source_col), "terms")
    vocab = vocabulary(counts, min_docs)
    cells = cut(
        counts.filter("term is not null").select("lang", "source", "term", "n").join(vocab, ["lang", "term"]), "cells"
    )
    langs = vocab.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    of_lang = Window.partitionBy("lang")
    tiles = F.ceil(F.count("*").over(of_lang) / F.lit(TILE)).cast("int")
    groups = cut(
        counts.filter("term is null")
        .select("lang", "source")
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(langs.select("lang", "kept"), "lang", "left")
        .na.fill(0, ["total", "kept"])
        .withColumn("tiles", tiles)
        .withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")),
        "groups",
    )
    ordered = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(cells, groups, vocab).withColumn("rank", F.row_number().over(ordered))
    terms = term_values(cells, groups, langs).withColumn("rank", F.row_number().over(ordered)).filter(F.col("rank") <= top)
    cols = ("lang", "source", "part", "item", "value", "rank")
    return pairs.withColumn("part", F.lit("pair")).select(*cols).unionByName(terms.withColumn("part", F.lit("term")).select(*cols))


ORACLE_SQL = r"""
with d as (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
), w as (
  select id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d
), c as (
  select id, lang, source, term, count(*) as n from w group by all
), v as (
  select lang, term, sum(n)::bigint as lang_n from c group by lang, term having count(*) >= 30
), l as (
  select lang, count(*) as kept, sum(lang_n)::bigint as lang_total from v group by lang
), s as (
  select c.lang, c.source, c.term, sum(c.n)::bigint as n from c join v using (lang, term) group by all
), g as (
  select lang, source, coalesce(kept, 0) as kept, coalesce(total, 0) as total
  from (select distinct lang, source from d) left join l using (lang)
  left join (select lang, source, sum(n)::bigint as total from s group by all) using (lang, source)
), p as (
  select g.lang, g.source, v.term, coalesce(s.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(s.n, 0) + 5)) // (g.total + 5 * g.kept) as p,
         1 + (1000000000::hugeint * (v.lang_n + 5)) // (l.lang_total + 5 * l.kept) as of_lang
  from g join v using (lang) join l using (lang) left join s on s.lang = g.lang and s.source = g.source and s.term = v.term
), f as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(sum(abs(x.p - y.p)), 0) as value
  from g a join g b on a.lang = b.lang and a.source != b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all
  union all
  select lang, source, 'term', term, p - of_lang from p where n > 0 and p > of_lang
), r as (
  select lang, source, part, item, value::bigint as value,
         row_number() over (partition by lang, source, part order by value desc, item)::integer as rank
  from f
)
select * from r where part = 'pair' or rank <= 50
"""
