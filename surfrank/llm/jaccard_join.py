"""N-gram Jaccard join with parity sketches.

A document is its set of word shingles.  Equal sets are one class.  For the
others:

1. Sketch.  A set's sketch is P cells of 64 bits; every shingle is hashed to
   one cell and XORed into it.  A shingle that is in one of two sets only
   changes one cell, so the number of cells that differ bounds the
   symmetric difference from below.
2. Pigeonhole, by size band.  Two sets that are similar enough have sizes
   in the same or neighbouring bands, and differ in at most d shingles,
   where d follows from the threshold and the band's largest size.  With
   P = d + 1 + spare cells they agree in at least 1 + spare cells.  Each set
   is keyed by its cells in its own band and in the next one (where it is
   the smaller of a pair).  Empty cells agree in everything; a set emits
   them only if it has more than ``spare``, so no link is lost and no huge
   group of empty cells comes to be.
3. Candidates.  Keys are sorted over the cluster and scanned as a stream;
   each run of equal keys is a star, its first set linked to every other
   one, never all pairs.
4. Verification of each set with the star that it shares most cells with;
   connected components.  Then, in rounds, of one link of a star between each
   two components, which merges most of them.  Verification is on the whole
   texts; only pairs that sizes and bit sketches (5) leave possible are brought
   together with them.
5. Two sets that are similar have a star (a run's first set) in common.
   In stars that still hold more than one component the sets (and the star) of different
   components are compared in bounded blocks by bit sketches: a shingle
   flips one bit, so the Hamming distance also bounds the symmetric
   difference from below.  Pairs within the bound are verified as well.
   After that no link can join two components.

Cases: null, empty and blank texts have no shingles, are linked with
nothing and are components of their own; texts with fewer than k words
are one shingle; repeated rows are one class; an empty table gives an empty
result; extra columns are ignored; a component without any id has none.
A class is known by a 64-bit digest of its shingles' hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, plain_names, ship
from .components import components
from .shingles import digest, mix, shingle_set, word_hashes

#: Sets of one star that are compared in one task.
BLOCK = 4096
#: Rounds that verify one link between each two components before sets are compared one by one.
MERGES = 2
#: Texts that a Python worker holds at once.
TEXTS_AT_ONCE = 2000


class Bands:
    """Size bands for a threshold ``percent``; d, spare and number of cells of each."""

    def __init__(self, percent: int):
        self.percent = percent
        self.step = math.log(100 / percent) * (1 + 1e-9)
        self.known: dict[int, tuple[int, int, int]] = {}

    def band(self, n: int) -> int:
        return int(math.log(n) / self.step + 1e-9)

    def cells(self, band: int) -> tuple[int, int, int]:
        """(d, spare, cells); cells is 0 where only equal sets can be linked."""
        if band not in self.known:
            top = math.ceil(math.exp((band + 1) * self.step)) + 1
            d = 2 * top * (100 - self.percent) // (100 + self.percent)
            spare = 2 + d // 20
            self.known[band] = d, spare, d + 1 + spare if d else 0
        return self.known[band]

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Join keys of a sorted set."""
        out = []
        own = self.band(len(shingles))
        for band in (own, own + 1):
            _, spare, cells = self.cells(band)
            if not cells:
                continue
            cell = ((shingles >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)  # rises with the hash
            first = np.flatnonzero(np.diff(cell, prepend=cell[0] + np.uint64(1)))
            value = np.bitwise_xor.reduceat(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), first)
            place = cell[first]
            if cells - len(place) > spare:
                empty = np.setdiff1d(np.arange(cells, dtype=np.uint64), place)
                value, place = np.concatenate([value, np.zeros(len(empty), np.uint64)]), np.concatenate([place, empty])
            out.append(mix(value ^ mix(place + np.uint64(band + 1) * np.uint64(1 << 40))))
        return np.concatenate(out) if out else shingles[:0]


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _facts(rows: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(w, k) for w in word_hashes(batch.column(2).to_pylist())]
            n = pa.array([len(s) for s in sets], pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), n, pa.array([digest(s) for s in sets], pa.int64())], names=["doc_id", "at", "n", "set"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "at", "text").mapInArrow(run, f"doc_id {kind}, at long, n long, set long")


def _keyed(rows: DataFrame, k: int, percent: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            keys, sets, held = [], [], 0
            for w in word_hashes(batch.column(0).to_pylist()):
                s = shingle_set(w, k)
                if len(s):
                    got = bands.keys(s)
                    keys.append(got)
                    sets.append(np.full(len(got), digest(s), np.int64))
                    held += len(got)
                    if held > 1 << 18:
                        yield _pairs(np.concatenate(keys).view(np.int64), np.concatenate(sets))
                        keys, sets, held = [], [], 0
            if held:
                yield _pairs(np.concatenate(keys).view(np.int64), np.concatenate(sets))

    return rows.select("text").mapInArrow(run, "key long, set long")


def _sketched(texts: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(w, k) for w in word_hashes(batch.column(1).to_pylist())]
            n, got = pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())
            yield pa.record_batch([*batch.columns, n, got], names=["set", "text", "n", "sketch"])

    return texts.mapInArrow(run, "set long, text string, n long, sketch binary")


def _pairs(key: np.ndarray, one: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(key), pa.array(one)], names=["key", "set"])


def _runs(keyed: DataFrame) -> DataFrame:
    """(key, first, set) of all sets in runs of two sets or more; first is the run's smallest set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_first = last_set = None  # of the row before the batch
        told = False  # whether that row's run has been told of
        for batch in batches:
            key, one = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            if last_key is not None:
                key, one = np.concatenate([[last_key], key]), np.concatenate([[last_set], one])
            if not len(key):
                continue
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (one[1:] != one[:-1])
            key, one = key[new], one[new]
            starts = np.ones(len(key), bool)
            starts[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(starts)
            first = one[at]
            if last_key is not None:
                first[0] = last_first
            length = np.diff(np.append(at, len(key)))
            many = length > 1
            many[0] |= told
            keep = np.repeat(many, length)
            firsts = np.repeat(first, length)
            if told:
                keep[0] = False  # the row before the batch
            last_key, last_first, last_set, told = key[-1], first[-1], one[-1], bool(many[-1])
            if keep.any():
                yield pa.record_batch([pa.array(key[keep]), pa.array(firsts[keep]), pa.array(one[keep])], names=["key", "first", "set"])

    return keyed.repartition("key").sortWithinPartitions("key", "set").mapInArrow(run, "key long, first long, set long")


def _possible(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``pairs`` (a, b) without those that sizes or sketches tell apart; ``texts``: set, n, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, one, two = (batch.column(i).to_pylist() for i in range(2, 6))
            good = [i for i in range(batch.num_rows) if _within(n_a[i], n_b[i], one[i], two[i], percent)]
            yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))

    for side in ("b", "a"):
        of = texts.select(F.col("set").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}"))
        pairs = pairs.join(of, side)
    sized = pairs.filter(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    return sized.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _within(n_a: int, n_b: int, one: bytes, two: bytes, percent: int) -> bool:
    """Whether two sets can be similar by the Hamming distance of their sketches."""
    x, y = folded([one, two])
    return int(np.bitwise_count(x ^ y).sum()) * (100 + percent) <= (n_a + n_b) * (100 - percent)


def _verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole texts are similar; ``texts``: set, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, left = None, None
        for batch in batches:
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            good = []
            for i, w in enumerate(word_hashes(text_b)):
                if a[i] != at:  # rows of one left side stand together
                    at, left = a[i], shingle_set(next(word_hashes([text_a[i]])), k)
                if similar(left, shingle_set(w, k), percent):
                    good.append(i)
            yield pa.record_batch([batch.column(0).take(pa.array(good, pa.int64())), batch.column(1).take(pa.array(good, pa.int64()))], names=["a", "b"])

    left = texts.select(F.col("set").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("set").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def link(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, class_id.

    ``class_id`` is the smallest doc_id with the same set of shingles.
    """
    return _linked(docs, k, percent, id_col, text_col).drop("at", "root")


def _linked(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``link`` with at, the hash of a row's id and text, and root, its component (null without shingles)."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(id_col, text_col).alias("at"), F.col(text_col).alias("text"))
    facts = cut(_facts(rows, k), batch=TEXTS_AT_ONCE)
    runs = cut(_runs(_keyed(rows, k, percent)))
    sets = facts.filter("n > 0").groupBy("set").agg(F.min("doc_id").alias("class_id"), F.min("at").alias("at"), F.first("n").alias("n"))

    wanted = runs.select("set").distinct().join(sets, "set").select("set", "at")
    texts = cut(_sketched(rows.select("at", "text").join(wanted, "at").groupBy("set").agg(F.first("text").alias("text")), k), batch=TEXTS_AT_ONCE)

    stars = cut(runs.filter("first != set").groupBy(F.col("first").alias("a"), F.col("set").alias("b")).agg(F.count("*").alias("cells")))
    best = stars.groupBy("b").agg(F.max(F.struct("cells", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")
    links = cut(_verified(_possible(best, texts, percent), texts, k, percent), batch=TEXTS_AT_ONCE)
    roots = components(links)
    for _ in range(MERGES):
        new = cut(_verified(_possible(_between(stars, roots), texts, percent), texts, k, percent), batch=TEXTS_AT_ONCE)
        if new.isEmpty():
            break
        links = links.unionByName(new)
        roots = components(links)
    across = _across(stars, roots, texts.drop("text"), percent)
    more = cut(_verified(across, texts, k, percent), batch=TEXTS_AT_ONCE)
    if not more.isEmpty():
        roots = components(links.unionByName(more))

    classes = sets.select("set", "class_id").join(roots.withColumnRenamed("node", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    named = classes.groupBy("root").agg(F.min("class_id").alias("component_id"))
    classes = classes.join(named, "root").select("set", "class_id", "component_id", "root")
    alone = F.col("n") == 0
    return facts.withColumn("_set", F.when(~alone, F.col("set"))).drop("set").join(
        classes.withColumnRenamed("set", "_set"), "_set", "left"
    ).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "at",
        "root",
    )


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows of a component but its first; same columns.

    First is the smallest id (null last), of equal ids the smallest hash of
    id and text; rows equal in both stay or go together.  Rows without
    shingles stay.
    """
    linked = cut(_linked(docs, k, percent, id_col, text_col).filter("root is not null").select("doc_id", "at", "root"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "at")
    firsts = linked.groupBy("root").agg(F.min(place).alias("first"))
    gone = linked.join(firsts, "root").filter("at != first.at").select(F.col("at").alias("_gone")).distinct()
    plain, ends = plain_names(docs, id_col, text_col)
    return plain.join(gone, F.xxhash64(*ends) == F.col("_gone"), "left_anti").toDF(*docs.columns)


def sketch(shingles: np.ndarray) -> bytes:
    """Parity bits of a set, at least two for each shingle; every shingle flips one bit."""
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    place = mix(shingles ^ np.uint64(0x14057B7EF767814F)) & np.uint64(bits - 1)
    parity = np.bincount(place.astype(np.int64), minlength=bits) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes]) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the narrowest (which keeps the bound)."""
    width = min(map(len, sketches))
    out = np.zeros((len(sketches), width // 8), np.uint64)
    for i, s in enumerate(sketches):
        words = np.frombuffer(s, np.uint64)
        while len(words) * 8 > width:
            words = words[: len(words) // 2] ^ words[len(words) // 2 :]
        out[i] = words
    return out


def _between(stars: DataFrame, roots: DataFrame) -> DataFrame:
    """For each two components with a star's link between them, the link with most cells."""
    for side in ("a", "b"):
        of = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        stars = stars.join(of, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return (
        stars.filter("root_a != root_b")
        .groupBy(F.least("root_a", "root_b"), F.greatest("root_a", "root_b"))
        .agg(F.max(F.struct("cells", "a", "b")).alias("best"))
        .select("best.a", "best.b")
    )


def _across(stars: DataFrame, roots: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of one star but of different components whose sketches are near enough.

    Stars are compared in blocks of at most about ``BLOCK`` sets against
    each other; only pairs within the Hamming bound leave a task.
    """
    members = stars.select(F.col("a").alias("star"), F.col("b").alias("set"))
    members = members.unionByName(stars.select(F.col("a").alias("star"), F.col("a").alias("set")).distinct()).join(roots.withColumnRenamed("node", "set"), "set", "left")
    members = members.withColumn("root", F.coalesce("root", "set"))
    mixed = (
        members.groupBy("star")
        .agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("n"))
        .filter("x != y")
        .select("star", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    )
    members = members.join(mixed, "star")
    listed = members.groupBy("set").agg(F.collect_list("star").alias("stars"))
    rows = (
        members.join(sketches, "set")
        .join(listed, "set")
        .withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("star", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set", "root", "n", "sketch", "stars")
    )

    def compare(key: tuple, block: pa.Table) -> pa.Table:
        first = np.array([x.as_py() for x in block["block"]]) == key[1].as_py()
        one, root, n = (block[c].to_numpy() for c in ("set", "root", "n"))
        words = folded(block["sketch"].to_pylist())
        inside = key[1] == key[2]
        star, stars = key[0].as_py(), [set(x) for x in block["stars"].to_pylist()]
        a, b = [], []
        for x in np.flatnonzero(first):
            near = root != root[x]
            near &= (one > one[x]) if inside else ~first
            y = np.flatnonzero(near)
            y = y[100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])]
            apart = np.bitwise_count(words[y] ^ words[x]).sum(1)
            y = y[apart * (100 + percent) <= (n[y] + n[x]) * (100 - percent)]
            y = y[[min(stars[x] & stars[i]) == star for i in y]] if len(y) else y  # once, in the pair's first star
            a.append(np.minimum(one[y], one[x]))
            b.append(np.maximum(one[y], one[x]))
        none = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(a or none), "b": np.concatenate(b or none)})

    return rows.groupBy("star", "i", "j").applyInArrow(compare, "a long, b long").distinct()


#: The registered query: four-word shingles, similarity 0.85.
ORACLE_SQL = r"""
with recursive w as (
  select doc_id, [x for x in string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as w
  from documents
), s as (
  select distinct doc_id, unnest(case
    when len(w) >= 4 then [array_to_string(w[i:i + 3], ' ') for i in range(1, len(w) - 2)]
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g
  from w
), n as (
  select doc_id, count(*) as n, md5(string_agg(g, '|' order by g)) as everything from s group by doc_id
), linked as (
  select a.doc_id as x, b.doc_id as y from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, na.n, nb.n having 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, l.y from reach r join linked l on l.x = r.other
), least as (
  select doc_id, min(other) as component_id from reach group by doc_id
)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, least.component_id,
       coalesce(min(d.doc_id) over (partition by n.everything) + 0 * n.n, d.doc_id) as class_id
from documents d join least on least.doc_id = d.doc_id left join n on n.doc_id = d.doc_id
"""
