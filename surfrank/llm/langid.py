"""Language ID: averaged hashed subword embeddings with a linear softmax.

Subwords are the runs of one to three characters of the lower-cased text in
which every character that is no letter counts as a blank; runs of blanks
alone are left out.  They hash into ``BUCKETS`` embeddings; a text is the
average of its subwords' embeddings, and a linear softmax over it gives the
languages.  Embeddings and weights are trained together by stochastic
gradient descent in numpy.

The classifier is fitted on a bounded sample: at most about ``per_lang``
labelled rows of each language, picked by a hash of the id.  Four fifths of
it train; on the last fifth a temperature is fitted, so that the score is a
calibrated probability, and the rejection bound is set: the score that all
but ``reject`` of those rows reach.

Every text is scored whole, where it lies, without a shuffle.  For scoring
embeddings and weights are multiplied beforehand into one row of numbers
for each bucket; that table has a fixed size and is broadcast.

Cases: null text and text without a letter are ``und`` with score 0 and
rejected; rows without a language are not learned from; without any
labelled row every text is ``und``; repeated rows get equal results; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_name, ship

BUCKETS = 1 << 14
DIM = 16
PER_LANG = 800
CHUNK_CHARS = 1 << 18
UNKNOWN = "und"

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For chunks of the joined texts: number of the text and bucket of each subword.

    Yields (text number, bucket, texts that have a letter); a text longer
    than a chunk comes in parts that overlap by two characters.
    """
    at, held, size = [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(len(t), 1), CHUNK_CHARS):
            part = t[max(0, a - 2) : a + CHUNK_CHARS]
            at.append((i, 2 if a else 0))
            held.append(" " * (not a) + part.lower() + " " * (a + CHUNK_CHARS >= len(t)))
            size += len(part)
            if size >= CHUNK_CHARS:
                yield _subwords(at, held)
                at, held, size = [], [], 0
    if held:
        yield _subwords(at, held)


def _subwords(at: list[tuple[int, int]], parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = [np.frombuffer(p.encode("utf-32-le", "surrogatepass"), np.uint32) for p in parts]
    owner = np.repeat(np.array([i for i, _ in at]), [len(c) for c in codes])
    piece = np.repeat(np.arange(len(at)), [len(c) for c in codes])
    code = np.concatenate(codes)
    fresh = np.concatenate([np.arange(len(c)) >= skip for c, (_, skip) in zip(codes, at, strict=True)])  # not the overlap
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(32)).astype(np.uint64)
    seen = np.unique(owner[letter])
    found, owners = [], []
    run = np.zeros(len(code), np.uint64)
    any_letter = np.zeros(len(code), bool)
    for n in (1, 2, 3):
        m = len(code) - n + 1
        if m <= 0:
            break
        run = run[:m] * np.uint64(0x9E3779B97F4A7C15) + code[n - 1 :] + np.uint64(n)
        any_letter = any_letter[:m] | letter[n - 1 :]
        use = any_letter & (piece[:m] == piece[n - 1 :]) & fresh[n - 1 :]
        mixed = run[use]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        found.append((mixed >> np.uint64(50)).astype(np.int64))
        owners.append(owner[:m][use])
    return np.concatenate(owners), np.concatenate(found), seen


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # bucket x language: embedding times weights
    bias: np.ndarray
    temperature: float
    bound: float  # scores below are rejected

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether rejected, for each text."""
        n, k = len(texts), len(self.langs)
        logits, count, seen = np.zeros((n, max(k, 1))), np.zeros(n), np.zeros(n, bool)
        if k:
            for owner, bucket, has in subwords([t or "" for t in texts]):
                order = owner.argsort(kind="stable")  # subwords of a text stand together
                owner, rows = owner[order], self.table[bucket[order]]
                if len(owner):
                    first = np.flatnonzero(np.diff(owner, prepend=-1))
                    logits[owner[first]] += np.add.reduceat(rows, first, axis=0)
                    count += np.bincount(owner, minlength=n)
                seen[has] = True
        p = softmax((logits / np.maximum(count, 1)[:, None] + (self.bias if k else 0)) / self.temperature)
        best = p.argmax(1)
        score = np.where(seen, p[np.arange(n), best], 0.0)
        lang = [self.langs[b] if s else UNKNOWN for b, s in zip(best, seen, strict=True)]
        return lang, score, ~seen | (score < self.bound)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def fit(features: list[tuple[np.ndarray, np.ndarray]], langs: list[str], steps: int = 1500, batch: int = 16, rate: float = 12.0, reject: float = 0.002, seed: int = 0) -> Model:
    """Train on (bucket, count) pairs of texts and their languages, in ``steps`` batches or somewhat more."""
    names = sorted(set(langs))
    if not names:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0, 1.0)
    y = np.searchsorted(names, langs)
    rng = np.random.default_rng(seed)
    embed = rng.normal(0, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    weight, bias = np.zeros((DIM, len(names)), np.float32), np.zeros(len(names), np.float32)
    order = rng.permutation(len(y))
    test = order[: len(y) // 5]
    train = order[len(y) // 5 :] if len(y) >= 5 else order
    epochs, done = -(-steps * batch // len(train)), 0
    steps = epochs * -(-len(train) // batch)
    for _ in range(epochs):
        rng.shuffle(train)
        for a in range(0, len(train), batch):
            some = train[a : a + batch]
            speed = rate * (1 - done / steps)
            done += 1
            x = [(b, (c / c.sum()).astype(np.float32)) for b, c in (features[i] for i in some)]
            mean = np.stack([c @ embed[b] for b, c in x])
            err = softmax(mean @ weight + bias).astype(np.float32)
            err[np.arange(len(some)), y[some]] -= 1
            back = err @ weight.T
            weight -= speed / len(some) * (mean.T @ err)
            bias -= speed / len(some) * 0.1 * err.sum(0)
            for (b, c), g in zip(x, back, strict=True):
                embed[b] -= speed / len(some) * c[:, None] * g
    model = Model(names, embed @ weight, bias, 1.0, 0.0)
    if len(test):
        logit = np.stack([(c / c.sum()) @ model.table[b] for b, c in (features[i] for i in test)]) + bias
        heat = np.geomspace(0.05, 5, 80)
        loss = [-np.log(softmax(logit / t)[np.arange(len(test)), y[test]] + 1e-12).mean() for t in heat]
        model.temperature = float(heat[int(np.argmin(loss))])
        model.bound = float(np.quantile(softmax(logit / model.temperature).max(1), reject))
    return model


def train(docs: DataFrame, use: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = PER_LANG, **options) -> Model:
    """Fit on about ``per_lang`` rows of each language among those where ``use`` holds."""
    known = docs.filter(use & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in known.groupBy(F.col(lang_col)).count().collect()}
    share = F.lit(0.0)
    for lang, n in counts.items():
        share = F.when(F.col(lang_col) == lang, F.lit(per_lang / n)).otherwise(share)
    point = F.pmod(F.xxhash64(F.col(id_col), F.lit("language sample")), F.lit(1 << 20)) / (1 << 20)
    sample = known.filter(point < share).select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("at"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                count = np.zeros(BUCKETS, np.int64)
                for _, bucket, _ in subwords([text]):
                    count += np.bincount(bucket, minlength=BUCKETS)
                used = np.flatnonzero(count)
                if len(used):
                    yield pa.RecordBatch.from_pylist([{"at": at, "lang": lang, "bucket": used.tolist(), "count": count[used].tolist()}], schema=schema)

    schema = pa.schema([("at", pa.int64()), ("lang", pa.string()), ("bucket", pa.list_(pa.int32())), ("count", pa.list_(pa.int64()))])
    rows = sample.mapInArrow(run, "at long, lang string, bucket array<int>, count array<long>").collect()
    rows.sort(key=lambda r: (r["at"], r["lang"]))
    return fit([(np.array(r["bucket"]), np.array(r["count"], np.float64)) for r in rows], [r["lang"] for r in rows], **options)


def predicted(model: Model, text: Column, spark: SparkSession) -> Column:
    """struct(lang_pred, score, rejected) of a text; only the text goes to Python."""
    shared = spark.sparkContext.broadcast(model)
    ship(spark)

    @F.arrow_udf("struct<lang_pred:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        lang, score, rejected = shared.value.score(texts.to_pylist())
        columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
        return pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "rejected"])

    return predict(text)


def split_of(id_col: str = "doc_id") -> Column:
    """True for the rows that are held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learns from the rows that are not held out."""
    model = train(docs, ~split_of(id_col), id_col, text_col, lang_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), split_of(id_col).alias("held_out"), predicted(model, F.col(text_col), docs.sparkSession).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.rejected")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """``docs`` without the rows that are rejected; same columns."""
    model = train(docs, ~split_of(id_col), id_col, text_col, lang_col, **options)
    name = free_name(docs, "predicted")
    return docs.withColumn(name, predicted(model, F.col(text_col), docs.sparkSession)).filter(~F.col(f"{name}.rejected")).drop(name)
