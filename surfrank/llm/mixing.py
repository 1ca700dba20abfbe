"""Mixing sources to target weights with a low-discrepancy schedule.

1. Targets.  Sources share the total size by weight; a target stops at
   ``most`` times its source's size and the excess is shared again by
   weight until none is above.
2. Blocks.  The documents of a source stand in seeded random order (by id, text and,
   for rows equal in these, their number; not by where they were read) as one
   stream of words, which is cut into blocks of equal length (about
   ``block`` words, the same for all blocks of a source but for one word).
3. Schedule.  Slot t draws the golden-ratio point frac((t + 1/2) * phi), in whole
   numbers, so exact for every t, and maps it
   through the cumulative weights (target / block length) to a source.
   The rank of a slot among those of its source says which block it takes,
   round and round; a source's last slot is trimmed to the words that are
   missing to its target.
4. Join.  Slots are counted by block and joined to the pieces of documents
   that lie in the block.

Only DataFrame functions.  Nothing is grouped by source alone: streams and
ranks are prefix sums over (source, chunk), with chunks of bounded size, so
a source may hold any share of the rows.  The driver sees one row for each
source, never documents.

Cases: null text has size 0 and is never taken; the null source is a source
(last); an empty table, or one without words, has targets of 0; repeated
rows are documents of their own; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, plain_names

BLOCK = 64
#: Points of the schedule are whole numbers below 2^59: odd multiples of the golden ratio less one, in units of 2^-58.
POINTS = 1 << 59
STEP = 178136169051924977  # floor(2^58 * 0.6180339887...), odd


POINT = f"cast(pmod(cast(2 * id + 1 as decimal(20, 0)) * cast({STEP} as decimal(18, 0)), cast({POINTS} as decimal(18, 0))) as bigint)"


def targets(sizes: list[int], weights: list[int], most: int = 3) -> list[float]:
    """Share of each source; ``sizes`` and ``weights`` in the same order."""
    total, full = sum(sizes), set()
    while True:
        rest = total - sum(most * sizes[i] for i in full)
        weight = sum(w for i, w in enumerate(weights) if i not in full)
        unit = rest / weight if weight else 0.0
        above = {i for i in range(len(sizes)) if i not in full and unit * weights[i] > most * sizes[i]}
        if not above:
            return [float(most * s) if i in full else unit * weights[i] for i, s in enumerate(sizes)]
        full |= above


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _before(df: DataFrame, keys: list[str], chunk: str, order: list[str], value: Column, out: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows ahead with the same ``keys``, in order (chunk, *order)."""
    sums = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_s"))
    ahead = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, chunk, F.coalesce(F.sum("_s").over(ahead), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return local.join(sums, [*keys, chunk]).withColumn(out, F.col("_base") + F.col("_in")).drop("_in", "_base")


def _copies(rows: DataFrame) -> DataFrame:
    """Adds ``_copy``, which numbers rows of one source, id and text from 0; few rows have more than one."""
    rows = rows.withColumn("_same", F.xxhash64("_source", "doc_id", "text_hash"))
    often = rows.groupBy("_same").count().filter("count > 1").select("_same")
    part = F.shiftright("_row", 33).alias("_part")  # the partition that the row was read in: a third of all rows is many of them
    repeats = rows.join(often, "_same", "left_semi").select("*", part)
    numbered = _before(repeats, ["_same"], "_part", ["_row"], F.lit(1), "_copy").drop("_part")
    once = rows.join(often, "_same", "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    return once.unionByName(numbered).drop("_same")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3,
    block: int = BLOCK,
    chunk_rows: int = 2000,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken, text_hash."""
    spark = docs.sparkSession
    rows = (
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("_source"),
            n_words(F.col(text_col)).alias("size"),
            F.xxhash64(F.col(text_col)).alias("text_hash"),
            F.monotonically_increasing_id().alias("_row"),
        )
    )
    rows = cut(rows)
    rows = cut(_copies(rows))
    by_source = rows.groupBy("_source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    by_source.sort(key=lambda r: (r["_source"] is None, (r["_source"] or "").encode()))
    sizes = [r["size"] for r in by_source]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], most)
    facts = []
    for i, (r, want) in enumerate(zip(by_source, goal, strict=True)):
        blocks = max(1, -(-r["size"] // block))
        words = round(want)
        facts.append(
            {
                "sid": i,
                "name": r["_source"],
                "size": r["size"],
                "target": want,
                "chunks": max(1, -(-r["n"] // chunk_rows)),
                "blocks": blocks,
                "words": words,
                # slots that fill the target: whole rounds, then blocks of the last round
                "slots": _slots(words, r["size"], blocks),
            }
        )
    schema = "sid int, name string, size long, target double, chunks long, blocks long, words long, slots long"
    sources = spark.createDataFrame([tuple(f.values()) for f in facts], schema)
    placed = rows.withColumnRenamed("size", "_size").join(
        sources.select("sid", "name", "size", "chunks", "blocks", "target"), F.col("_source").eqNullSafe(F.col("name"))
    )
    placed = placed.withColumn("_order", F.xxhash64(F.lit(seed), "doc_id", "text_hash", "_copy")).withColumn(
        "_chunk", F.shiftrightunsigned("_order", 33) % F.col("chunks")
    )
    placed = placed.select("sid", "_chunk", "_order", "_copy", "_row", "doc_id", "text_hash", "_size", "size", "blocks", "target")
    placed = _before(placed, ["sid"], "_chunk", ["_order", "doc_id", "text_hash", "_copy", "_row"], F.col("_size"), "_start")
    taken = _taken(placed, schedule(sources, facts))
    return placed.join(taken, "_row", "left").select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("size").alias("source_size"),
        "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
        "text_hash",
    )


def _edge(b: int, size: int, blocks: int) -> int:
    """First word of block b when ``size`` words are cut into ``blocks`` equal blocks."""
    return b * (size // blocks) + min(b, size % blocks)


def _slots(words: int, size: int, blocks: int) -> int:
    if not size:
        return 0
    rounds, left = divmod(words, size)
    b = left * blocks // size
    while b and _edge(b - 1, size, blocks) >= left:
        b -= 1
    while _edge(b, size, blocks) < left:
        b += 1
    return rounds * blocks + b


def schedule(sources: DataFrame, facts: list[dict]) -> DataFrame:
    """slot, sid, rank, block, words taken, of all slots of the mix.

    The number of points grows until every source has its slots; those
    beyond a source's number are passed over.
    """
    spark = sources.sparkSession
    wanted = {f["sid"]: f["slots"] for f in facts if f["slots"]}
    total = sum(wanted.values())
    edges, at = [], 0
    for sid in wanted:
        at += wanted[sid]
        edges.append((at * POINTS // total, sid))
    points = total + 16
    pick = F.lit(edges[-1][1]) if edges else F.lit(0)
    pick = F.element_at(
        F.array(*[F.lit(s) for _, s in edges] or [F.lit(0)]),
        F.least(F.size(F.filter(F.array(*[F.lit(e) for e, _ in edges] or [F.lit(POINTS)]), lambda e: e <= F.col("u"))) + 1, F.lit(max(1, len(edges)))),
    )
    while True:
        drawn = (
            spark.range(points if total else 0)
            .select(F.col("id").alias("slot"), F.expr(POINT).alias("u"))
            .select("slot", pick.alias("sid"), F.floor(F.col("slot") / 4096).alias("_part"))
        )
        got = {r["sid"]: r["count"] for r in drawn.groupBy("sid").count().collect()}
        if all(got.get(s, 0) >= n for s, n in wanted.items()):
            break
        points += max(16, max(-(-(n - got.get(s, 0)) * total // n) for s, n in wanted.items()) + total // 100)
    ranked = _before(drawn, ["sid"], "_part", ["slot"], F.lit(1), "rank")
    full = ranked.join(sources.drop("name", "target", "chunks"), "sid").filter("rank < slots")
    base, extra = F.expr("size div blocks"), F.col("size") % F.col("blocks")
    block = F.col("rank") % F.col("blocks")
    whole = base + F.when(block < extra, 1).otherwise(0)
    begun = F.expr("rank div blocks") * F.col("size") + block * base + F.least(block, extra)
    return full.select(
        "slot", "sid", "rank", block.alias("block"), F.least(whole, F.col("words") - begun).alias("take"), whole.alias("length")
    )


def _taken(placed: DataFrame, slots: DataFrame) -> DataFrame:
    """Words taken by row: pieces of documents joined to the counts of their blocks."""
    counts = slots.groupBy("sid", "block").agg(
        F.count(F.when(F.col("take") == F.col("length"), 1)).alias("_full"),
        F.coalesce(F.max(F.when(F.col("take") < F.col("length"), F.col("take"))), F.lit(0)).alias("_trim"),
    )
    end = F.col("_start") + F.col("_size")
    base, extra = F.expr("size div blocks"), F.col("size") % F.col("blocks")
    long_part = extra * (base + 1)  # the first blocks have a word more

    def block_of(word: Column) -> Column:
        return F.when(word < long_part, F.floor(word / (base + 1))).otherwise(extra + F.floor((word - long_part) / F.greatest(base, F.lit(1))))

    pieces = (
        placed.filter("_size > 0")
        .select("_row", "sid", "_start", end.alias("_end"), "size", "blocks", F.explode(F.sequence(block_of(F.col("_start")), block_of(end - 1))).alias("block"))
        .withColumn("_edge", F.col("block") * base + F.least(F.col("block"), extra))
        .withColumn("_stop", F.col("_edge") + base + F.when(F.col("block") < extra, 1).otherwise(0))
    )
    first, last = F.greatest("_start", "_edge"), F.least("_end", "_stop")
    trimmed = F.greatest(F.least(last, F.col("_edge") + F.col("_trim")) - first, F.lit(0))
    return (
        pieces.join(counts, ["sid", "block"])
        .groupBy("_row")
        .agg(F.sum((last - first) * F.col("_full") + trimmed).alias("_taken"))
    )


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each document as often as the mix takes it, to the nearest whole number.

    Documents without words take no share of the mix and stay once.
    """
    took = (
        mix(docs, id_col, text_col, source_col, **options)
        .groupBy("doc_id", "text_hash")
        .agg(F.max("size").alias("_size"), F.sum("taken").alias("_took"), F.count("*").alias("_n"))
        .withColumn("_times", F.when(F.col("_size") == 0, 1).otherwise(F.round(F.col("_took") / F.col("_n") / F.col("_size")).cast("int")))
        .filter("_times > 0")
        .select(F.col("doc_id").alias("_tid"), F.col("text_hash").alias("_thash"), "_times")
    )
    plain, (given, text) = plain_names(docs, id_col, text_col)
    out = plain.join(took, given.eqNullSafe(F.col("_tid")) & (F.xxhash64(text) == F.col("_thash")))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*plain.columns).toDF(*docs.columns)
