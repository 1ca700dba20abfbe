from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from surfrank.llm import bloom_sketch, bpe, langid, recurrent_lm
from surfrank.llm.shingles import word_hashes
from tests.llm.helpers import WORD, awkward, documents, lowered

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.parse_ranks(bpe.load_ranks(RANKS)), special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.load_ranks(RANKS), PATTERN)


def test_bpe_equals_library(codec, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcdethe ing  \n\t'sré1290!?<|>aaaa日\U0001f600") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["".join(rng.choice("ab") for _ in range(3000)), "etaoin" * 200, "a" * 50_000, "<|endoftext|>", "\x1c \x85 "]
    assert list(codec.encode_many(texts)) == [library.encode_ordinary(t) for t in texts]
    assert all("".join(codec.decode(codec.encode(t))) == t for t in texts)


def test_bpe_is_the_same_with_small_tables(library, monkeypatch):
    small = bpe.Codec(bpe.load_ranks(RANKS), PATTERN)
    small.transducer.max_states = 50
    monkeypatch.setattr(bpe, "MAX_PIECES", 20)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 200)
    rng = random.Random(2)
    texts = ["".join(rng.choice("thearnsi oe,.") for _ in range(rng.randrange(500))) for _ in range(60)]
    assert list(small.encode_many(texts)) == [library.encode_ordinary(t) for t in texts]


def test_utf8_stream_holds_back(codec):
    data = "aé日\U0001f600!".encode()
    for size in (1, 2, 3, 5):
        stream = bpe.Utf8Stream()
        assert "".join([*(stream.feed(data[i : i + size]) for i in range(0, len(data), size)), stream.end()]) == data.decode()
    assert bpe.Utf8Stream().feed(b"\xff") == "�"


def test_bpe_rows(spark, library):
    docs = documents(spark, awkward())
    rows = bpe.round_trip(docs, RANKS, PATTERN).collect()
    want = Counter()
    for i, t in awkward():
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    assert Counter(map(tuple, rows)) == want
    back = bpe.decode(bpe.encode(docs, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert Counter(map(tuple, back)) == Counter((i, t or "") for i, t in awkward())
    assert bpe.round_trip(docs.limit(0), RANKS, PATTERN).count() == 0


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    assert sum(r.rejected for r in rows) <= 0.02 * len(rows)


def test_language_id_rejects_a_left_out_language():
    """The bound is the held-back rows' own quantile, also above 0.5."""
    rng = random.Random(4)
    letters = ["abcdefgh", "ijklmnop", "qrstuvwx"]

    def text(of):
        return " ".join("".join(rng.choice(of) for _ in range(rng.randrange(3, 8))) for _ in range(40))

    features, langs = [], []
    for i in range(300):
        count = np.zeros(langid.BUCKETS)
        for _, bucket, _ in langid.subwords([text(letters[i % 2])]):
            count += np.bincount(bucket, minlength=langid.BUCKETS)
        used = np.flatnonzero(count)
        features.append((used, count[used]))
        langs.append("xy"[i % 2])
    model = langid.fit(features, langs, steps=300)
    assert model.bound > 0.5
    known, left_out = [text(letters[i % 2]) for i in range(100)], [text(letters[2]) for _ in range(100)]
    assert model.score(known)[2].mean() <= 0.05
    assert model.score(left_out)[2].mean() >= 0.9


def test_language_id_awkward(spark):
    docs = documents(spark, awkward())
    rows = langid.identify(docs).collect()
    assert len(rows) == len(awkward())
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in rows if r.doc_id in (2, 3, 4))
    assert {r.lang_pred for r in rows if r.doc_id in (1, 5, 6)} == {"en"}
    assert langid.accepted(docs).columns == docs.columns
    assert langid.identify(docs.limit(0)).count() == 0
    none = langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in none} == {"und"}


def test_subwords_do_not_depend_on_chunks(monkeypatch):
    text = ["Ein Satz über Äpfel, 12 Birnen und Istanbul." * 5, "x", ""]

    def counted():
        out = Counter()
        for owner, bucket, _ in langid.subwords(text):
            out.update(zip(owner.tolist(), bucket.tolist(), strict=True))
        return out

    whole = counted()
    monkeypatch.setattr(langid, "CHUNK_CHARS", 40)
    parts = counted()
    assert parts == whole


def test_word_hashes_match_words():
    texts = ["Aa aA\tbb", None, "", "x", " aa\x0bBB ", "é É"]
    got = [h.tolist() for h in word_hashes(texts)]
    assert [len(g) for g in got] == [len(WORD.findall(t or "")) for t in texts]
    assert got[0] == [got[4][0], got[4][0], got[4][1]] and got[5][0] != got[5][1]


def test_recurrent_lm(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = recurrent_lm.score(docs, head=500, fit_tokens=30_000).collect()
    words = {r.doc_id: [*WORD.findall(lowered(r.text)), "\n"] for r in docs.collect()}
    learned = [i for i in words if zlib.crc32(str(i).encode()) % 7 != 2]
    count = Counter(w for i in learned for w in words[i])
    n, v = sum(count.values()), len(count)
    for r in rows:
        w = words[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (r.doc_id not in set(learned), len(w), sum(x in count for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_recurrent_lm_learns_from_all_training_texts(spark):
    """Classes are those of the complete counts, and the network goes through every token, however small the first sample."""
    texts = [" ".join(f"word{(i * j) % 150}" for j in range(1, 60)) for i in range(300)] + ["tail " * 30_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "at long, text string").repartition(3)
    model, _ = recurrent_lm.train(rows, fit_tokens=2000)
    count = Counter(int(h) for hashes in word_hashes(texts) for h in hashes)
    low = sorted(count.values())[-recurrent_lm.WORD_CLASSES]
    assert len(model.classes.words) == recurrent_lm.WORD_CLASSES
    assert {h for h, c in count.items() if c > low} <= set(model.classes.words.tolist()) <= {h for h, c in count.items() if c >= low}
    assert model.fitted == model.train_tokens == sum(count.values()) + len(texts)
    words, _ = recurrent_lm._sample(rows, 0.2)
    assert 0 < sum(map(len, words)) < 0.4 * model.train_tokens and max(map(len, words)) <= recurrent_lm.SAMPLE_WINDOW
    start = recurrent_lm.Recurrent(model.classes.n)
    hashes, ends = zip(*recurrent_lm.words_and_ends(texts), strict=True)
    classes = [np.append(model.classes.of(w, e), 0) for w, e in zip(hashes, ends, strict=True)]
    flat, lengths = np.concatenate(classes), np.array([len(c) for c in classes])
    assert model.net.score(flat, lengths).sum() > start.score(flat, lengths).sum()


def test_recurrent_lm_probabilities_sum_to_one():
    """Over all outcomes of the next token: classes, then counts within a class."""
    rng = np.random.default_rng(0)
    net = recurrent_lm.Recurrent(7, hidden=5)
    net.fit([np.append(rng.integers(1, 7, 20), 0) for _ in range(40)], streams=4, window=8)
    h = np.repeat(rng.normal(size=(1, 5)).astype(np.float32), 7, 0)
    assert np.exp(net.log_class(h, np.arange(7))).sum() == pytest.approx(1, abs=1e-5)


def test_recurrent_lm_carries_state_over_windows(monkeypatch):
    rng = np.random.default_rng(1)
    net = recurrent_lm.Recurrent(9, hidden=6)
    lengths = np.array([1, 40, 17, 90, 3])
    classes = rng.integers(0, 9, lengths.sum())
    whole = net.score(classes, lengths)
    monkeypatch.setattr(recurrent_lm, "WINDOW", 5)
    assert net.score(classes, lengths) == pytest.approx(whole)
    alone = [net.score(c, np.array([len(c)]))[0] for c in np.split(classes, np.cumsum(lengths)[:-1])]
    assert alone == pytest.approx(whole, abs=1e-4)


def test_recurrent_gradient():
    net = recurrent_lm.Recurrent(4, hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(2)
    y = rng.integers(0, 4, (2, 5))
    x = np.concatenate([np.full((2, 1), 4), y[:, :-1]], 1)
    x[1, 3] = 4  # a text begins inside the window
    h = rng.normal(size=(2, 3))

    def loss():
        at, total = h, 0.0
        for t in range(5):
            at = at * (x[:, t] != 4)[:, None]
            at = net.step(x[:, t], at)[0]
            total -= net.log_class(at, y[:, t]).sum()
        return total / 10

    grad, _ = net._window(x, y, h)
    for k, g in grad.items():
        for i in [(0,) * g.ndim, tuple(s - 1 for s in g.shape)]:
            old = net.p[k][i]
            net.p[k][i] = old + 1e-5
            up = loss()
            net.p[k][i] = old - 1e-5
            assert g[i] == pytest.approx((up - loss()) / 2e-5, abs=1e-4)
            net.p[k][i] = old


def test_recurrent_lm_awkward_and_empty(spark):
    docs = documents(spark, awkward())
    rows = recurrent_lm.score(docs).collect()
    assert len(rows) == len(awkward()) and all(r.score < 0 for r in rows)
    assert all(r.n_tokens == 1 for r in rows if r.doc_id in (2, 3, 4))
    assert len({(r.score, r.base_score) for r in rows if r.doc_id == 1}) == 1
    assert recurrent_lm.score(docs.limit(0)).count() == 0


def test_recurrent_lm_repeated_rows_in_batches_of_all_sizes(spark, monkeypatch):
    """A row has the score of its repetitions, which stand in batches of other sizes; texts become classes once."""
    monkeypatch.setattr(recurrent_lm, "TEXTS_AT_ONCE", 7)
    made = []
    coded = recurrent_lm._coded
    monkeypatch.setattr(recurrent_lm, "_coded", lambda *a: made.append(1) or coded(*a))
    rng = random.Random(8)
    once = [(i, " ".join(rng.choice(["of", "the", "net", "word", "state"]) for _ in range(rng.randrange(1, 80)))) for i in range(40)]
    rows = recurrent_lm.score(documents(spark, once * 3 + once[:25]).repartition(5), fit_tokens=3000).collect()
    assert len(rows) == 145 and len(made) == 1
    assert len({(r.doc_id, r.n_tokens, r.base_score, r.score) for r in rows}) == 40


def sketch_brute(docs):
    docs = sorted(((i, t or "") for i, t in docs), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
    keys = lambda t: {p for p in t.split("\n") if p}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    out = []
    for i, (doc_id, text) in enumerate(docs):
        nxt, half = docs[(i + 1) % len(docs)][1], len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        near = round(like(keys(text), keys(edited)), 9), round(like(keys(text), keys(nxt)), 9)
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), *near))
    return Counter(out)


@pytest.mark.parametrize("load", [1.5, 0.4])
def test_bloom_sketch(spark, load):
    """Against sets of paragraphs; with small tables most pairs must be tried again."""
    rng = random.Random(4)
    docs = [(rng.randrange(10**6), "\n".join(rng.choice(["", "p%d" % rng.randrange(40)]) for _ in range(rng.randrange(60)))) for _ in range(60)]
    docs += awkward()
    rows = bloom_sketch.fingerprints(documents(spark, docs), load=load).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows) == sketch_brute(docs)
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1


def test_bloom_sketch_one_row_and_empty(spark):
    rows = bloom_sketch.fingerprints(documents(spark, [(1, "a\nb")])).collect()
    assert [(r.near_next, r.n_chars) for r in rows] == [(1.0, 3)]
    assert bloom_sketch.fingerprints(documents(spark, awkward()).limit(0)).count() == 0
