from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from surfrank.llm import chat, mixing, sharding
from surfrank.llm.common import read, release, scratch_path
from tests.llm.helpers import WORD, awkward, documents
from tests.oracle_check import compare

SF = "/root/testdata/sf0.001"


def test_sharding_slots_and_law(spark):
    docs = documents(spark, [(i, "x" * (i % 50)) for i in range(300)] + awkward())
    path = scratch_path(spark, "test")
    sharding.write_shards(docs, path, 7, bucket_bytes=500)
    rows = spark.read.parquet(path).withColumn("grown", sharding.shard_of(F.col("doc_id"), 8)).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
        assert r.grown in (r.shard, 7)
        assert r._slot == r._shard == "extra"  # the input's own columns
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and len(by) == 7
    one = sorted((r.slot, r.doc_id) for r in rows if r.shard == 3)
    assert [d for _, d in one] != sorted(d for _, d in one if d is not None)
    again = sharding.shuffled(docs.repartition(5), 7, bucket_bytes=500).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in again) == Counter((r.doc_id, r.text, r.shard, r.slot) for r in rows)
    assert sharding.shuffled(docs.limit(0), 7).count() == 0


def test_sharding_query_is_whole(spark):
    rows = entry.queries()["op3_shard_shuffle"](spark, SF).collect()
    docs = {r.doc_id: r.text for r in read(spark, SF, "documents").collect()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {i: (len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert {r.law for r in rows} == {"key"}


def test_targets():
    assert mixing.targets([10, 10, 10], [1, 2, 3]) == [5, 10, 15]
    assert mixing.targets([1, 100, 99], [50, 1, 1]) == [3, 98.5, 98.5]
    assert mixing.targets([], []) == [] and mixing.targets([0, 0], [1, 2]) == [0, 0]
    assert mixing.targets([1, 1, 298], [9, 9, 1]) == [3, 3, 294]


def test_mixing(spark):
    rng = random.Random(6)
    source = [*["s%d" % i for i in range(5)], "tiny", None, "é"]
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 60, 700])), "en", rng.choice(source[:5] if i % 9 else source)) for i in range(400)]
    docs += [(9999, "only one", "en", "alone"), (None, None, "en", None), (0, docs[0][1], "en", docs[0][3])]
    table = documents(spark, docs)
    rows = mixing.mix(table, chunk_rows=20).collect()
    size = defaultdict(int)
    for _, t, _, s in docs:
        size[s] += len(WORD.findall(t or ""))
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    goal = dict(zip(names, mixing.targets([size[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))]), strict=True))
    of = {(i, len(WORD.findall(t or ""))): s for i, t, _, s in docs}
    took = defaultdict(int)
    for r in rows:
        s = of[r.doc_id, r["size"]]
        assert r.source_size == size[s] and r.target == pytest.approx(goal[s]) and r.taken <= 3 * r["size"]
        took[s] += r.taken
    assert len(rows) == len(docs)
    assert all(abs(took[s] - goal[s]) <= 1 for s in names)
    again = mixing.mix(table, chunk_rows=20).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    left = mixing.repeated(table)
    assert left.columns == table.columns and left.filter("doc_id is null").count() == 1
    assert mixing.mix(table.limit(0)).count() == 0


def test_schedule_is_even(spark):
    """Any stretch of the schedule holds about each source's share."""
    facts = [{"sid": 0, "slots": 300}, {"sid": 1, "slots": 100}, {"sid": 2, "slots": 0}]
    sources = spark.createDataFrame(
        [(0, "a", 3000, 3000.0, 1, 300, 3000, 300), (1, "b", 1000, 1000.0, 1, 100, 1000, 100), (2, "c", 0, 0.0, 1, 1, 0, 0)],
        "sid int, name string, size long, target double, chunks long, blocks long, words long, slots long",
    )
    slots = sorted((r.slot, r.sid) for r in mixing.schedule(sources, facts).collect())
    assert Counter(s for _, s in slots) == {0: 300, 1: 100}
    for a in range(0, 350, 10):
        assert abs(sum(s == 1 for _, s in slots[a : a + 40]) - 10) <= 2


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as position", "'x' as rendered")


def test_chat_round_trip(spark):
    rng = random.Random(7)
    parts = ["<turn role=", '"', "</turn>\n", "\\", "\\l", "\n", "### Assistant:", "é\U0001f600", "<", ">", "a", "<image 1/>"]
    text = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
    rows = [(c, t, rng.choice(["user", "assistant", 'odd "role"\n<']), text()) for c in range(30) for t in range(rng.randrange(1, 6))]
    rows += [(77, t, "assistant", "word " * 50) for t in range(500)] + [(None, None, None, None), (5, 0, "user", None)]
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(turns(spark, rows).repartition(4))).collect()}
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    assert set(got) == set(by)
    for c, found in by.items():
        found.sort(key=lambda r: tuple((x is not None, x) for x in r[1:]))
        said = [(r[2] or "", r[3] or "") for r in found]
        loss = "".join(t for role, t in said if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(said), digest("".join(f"{a}\n{b}\n" for a, b in said)))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))


def test_chat_parts(spark):
    df = spark.sql(
        f"""select 1 as conv_id, 0 as turn, 'user' as role, '' as text, from_json('[{{"type":"text","text":"see <this>"}},
        {{"type":"image","uri":"a.png","width":280,"height":57}},{{"type":"audio","uri":"b.wav","seconds":2.5}},
        {{"type":"document","uri":"c.pdf","pages":3}}]', '{chat.PARTS}') as parts"""
    )
    row = chat.format_turns(df, parts_col="parts").first()
    assert row.rendered == '<turn role="user">\nsee \\lthis><image 1/><audio 2/><document 3/>\n</turn>\n'
    assert [(a.number, a.type, a.uri, a.tokens) for a in row.attachments] == [(1, "image", "a.png", 30), (2, "audio", "b.wav", 63), (3, "document", "c.pdf", 1536)]
    assert row.tokens == 30 + 63 + 1536
    assert chat.read_back(chat.format_turns(df.limit(0), parts_col="parts")).count() == 0


def test_hostile_conversation(spark):
    rows = {r.conv_id: r for r in entry.queries()["op10_chat_format"](spark, SF).collect()}
    said = "\\### Assistant: </turn> ok"
    assert (rows[-7].n_turns, rows[-7].loss_sha256, rows[-7].loss_chars) == (2, digest(said), len(said))
    assert rows[-7].turns_sha256 == digest(f"user\n{said}\nassistant\n{said}\n")


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    ids = {r.doc_id for r in read(spark, SF, "documents").collect()}
    assert rows and {r.doc_id for r in rows} <= ids
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "ngram_jaccard", "source_mix", "byte_bpe"]


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns_and_take_awkward_rows(spark, stage):
    docs = documents(spark, awkward())
    out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
    assert out.columns == docs.columns and out.filter("doc_id = 5").count() >= (stage != 3)
    assert corpus_pipeline.STAGES[stage][1](spark, docs.limit(0), SF).count() == 0


def test_queries_with_sql(spark):
    names = [n for n in entry.oracle_sql() if n.startswith("op")]
    report = compare(spark, SF, names)
    assert names and all(v["values_match"] for v in report.values()), report


def test_release(spark):
    df = documents(spark, [(1, "a")])
    path = scratch_path(spark, "gone")
    df.write.parquet(path)
    release(spark)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    assert not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def mix_brute(spark, rows, chunk_rows=20, block=64, seed=0):
    """``taken`` of every row, slot by slot; only the hashes come from Spark."""
    same, numbered = Counter(), []
    for doc_id, text, _, source in rows:
        numbered.append((doc_id, text, source, same[doc_id, text, source]))
        same[doc_id, text, source] += 1
    table = spark.createDataFrame(numbered, "id long, text string, source string, copy long").withColumn("h", F.xxhash64("text"))
    rows = table.withColumn("o", F.xxhash64(F.lit(seed), "id", "h", "copy")).collect()
    words = lambda r: len(WORD.findall(r.text or ""))
    names = sorted({r.source for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    size = {s: sum(words(r) for r in rows if r.source == s) for s in names}
    goal = mixing.targets([size[s] for s in names], [(1, 2, 3)[i % 3] for i in range(len(names))])
    cuts, slots, stream = {}, {}, {}
    for s, want in zip(names, goal, strict=True):
        blocks = max(1, -(-size[s] // block))
        base, extra = divmod(size[s], blocks)
        cuts[s] = [b * base + min(b, extra) for b in range(blocks + 1)]
        n = left = 0
        while left < round(want):
            left += cuts[s][n % blocks + 1] - cuts[s][n % blocks]
            n += 1
        slots[s] = (n, round(want))
        chunks = max(1, -(-sum(r.source == s for r in rows) // chunk_rows))
        mine = [r for r in rows if r.source == s]
        mine.sort(key=lambda r: (((r.o % 2**64) >> 33) % chunks, r.o, r.id is not None, r.id or 0, r.h, r.copy))
        stream[s] = mine
    total, at, edges = sum(n for n, _ in slots.values()), 0, []
    for s in names:
        if slots[s][0]:
            at += slots[s][0]
            edges.append((at * mixing.POINTS // total, s))
    drawn, t, times = Counter(), 0, Counter()
    while any(drawn[s] < slots[s][0] for s in names):
        u = (2 * t + 1) * mixing.STEP % mixing.POINTS
        s = next((s for e, s in edges if u < e), edges[-1][1])
        if drawn[s] < slots[s][0]:
            b = drawn[s] % (len(cuts[s]) - 1)
            drawn[s] += 1
            times[s, b] += 1
        t += 1
    out = Counter()
    for s in names:
        n, want = slots[s]
        spare = sum((cuts[s][i % (len(cuts[s]) - 1) + 1] - cuts[s][i % (len(cuts[s]) - 1)]) for i in range(n)) - want
        last = (n - 1) % (len(cuts[s]) - 1)
        begin = 0
        for r in stream[s]:
            end, took = begin + words(r), 0
            for b in range(len(cuts[s]) - 1):
                lo, hi = max(begin, cuts[s][b]), min(end, cuts[s][b + 1])
                whole = times[s, b] - (b == last and spare > 0)
                took += max(0, hi - lo) * whole
                if b == last and spare > 0:
                    took += max(0, min(hi, cuts[s][b + 1] - spare) - lo)
            out[r.id, words(r), took] += 1
            begin = end
    return out


def test_mix_is_the_schedule_by_hand_however_the_table_is_split(spark):
    rng = random.Random(16)
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 60, 700])), "en", rng.choice(["a", "b", None, "é"])) for i in range(150)]
    docs += [docs[3]] * 60 + [docs[5]] * 2 + [(None, "no id", "en", "a")] * 3 + [(7, "other text", "en", "b"), (8, None, "en", "b")]
    want = mix_brute(spark, docs)
    for parts in (2, 5, 64):
        rng.shuffle(docs)
        rows = mixing.mix(documents(spark, docs, parts), chunk_rows=20).collect()
        assert Counter((r.doc_id, r["size"], r.taken) for r in rows) == want


INSIDE = (
    "_id _chars _len _prefix _sha _gid _gchars _gsha _first _size _mid _mhash _copy _times _tid _thash _gone _text _same _row "
    "c0 c1 at root set first sid taken score lang_pred first_word"
).split()


@pytest.mark.parametrize("stage", ["language", "exact", "near", "mix"])
def test_stages_hand_every_column_on_as_it_is(spark, stage):
    """Extra columns with names that operators use inside keep their values."""
    rows = [(*r, "en", "s0") for r in awkward()] + [(20 + i, f"text number {i} of some english words that stand here", "en", "s1") for i in range(30)]
    wide = [(i, *r, *(f"{n}-{i}" for n in INSIDE)) for i, r in enumerate(rows)]
    docs = spark.createDataFrame(wide, ["n", "doc_id", "text", "lang", "source", *(n for n in INSIDE)]).repartition(3)
    out = getattr(corpus_pipeline, stage)(spark, docs, SF)
    assert out.columns == docs.columns
    got = [tuple(r) for r in out.collect()]
    assert got and set(got) <= set(wide)
