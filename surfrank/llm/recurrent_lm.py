"""LM scoring with a gated recurrent network and a class-factored softmax.

A token is a word (A-Z count as a-z) or a text's end.  Its probability is
P(class | all tokens before it) * P(token | class).

* Classes: the most frequent tokens of all training texts (a distributed
  top-k of the counts) are classes of their own; other words
  share a class by their last three bytes, if these are frequent, else the
  rest class.  Every such class has one outcome for words never met.
* Within a class the softmax's logits are log(count + 1).  The counts cover
  every training text; they are gathered by a distributed aggregation.
* The class comes from a gated recurrent unit that reads the classes of the
  tokens so far.  It is trained in numpy by truncated backpropagation
  through time: first on windows of texts, about ``fit_tokens`` tokens
  picked by hashes, which gives all tasks one start; then data-parallel on
  every training text, in ``ROUNDS`` disjoint parts.  In a round each task
  goes on from the shared weights over its texts, and the weights are
  averaged by tokens in a distributed aggregation.
* Words become classes once, in a pass that also sums the counts; training
  rounds and scoring read the written classes (16 bits a token).
* A text is scored whole: many texts step together through windows of
  ``WINDOW`` tokens, and each one's state is carried from window to window.

Counts of the ``head`` most frequent words are broadcast (bounded by that
parameter); all other words of the texts are joined to the counts.

Cases: null text is an empty text, with its end as the only token; without
training texts all counts are 0; repeated rows get equal results; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship
from .shingles import mix, words_and_ends

END = 0x2545F4914F6CDD1D  # stands for the hash of a text's end
HIDDEN = 24
WORD_CLASSES = 96
ENDING_CLASSES = 62
WINDOW = 16
FIT_TOKENS = 400_000
#: Words of a text that the first sample draws together.
SAMPLE_WINDOW = 256
ROUNDS = 2
ROUND_RATE = 0.002
HEAD = 1 << 18
WORDS_AT_ONCE = 1 << 19
#: Texts that a Python worker holds at once; they step through the network together.
TEXTS_AT_ONCE = 4000
#: States whose logits are held at once; so many stay in a core's cache.
ROWS_AT_ONCE = 512


@dataclass
class Classes:
    """Class of a word: its own, its ending's or the rest (the last class); class 0 is the end."""

    words: np.ndarray  # sorted hashes
    word_class: np.ndarray
    endings: np.ndarray  # sorted
    ending_class: np.ndarray

    @property
    def n(self) -> int:
        return 2 + len(self.words) + len(self.endings)

    def of(self, words: np.ndarray, endings: np.ndarray) -> np.ndarray:
        out = np.full(len(words), self.n - 1, np.int64)
        for keys, named, has in ((self.endings, self.ending_class, endings), (self.words, self.word_class, words)):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, has), len(keys) - 1)
                hit = keys[at] == has
                out[hit] = named[at[hit]]
        return out


def choose_classes(counts: DataFrame) -> Classes:
    """The most frequent words of ``counts`` and the most frequent endings of the others."""

    def frequent(rows: DataFrame, key: str, most: int) -> np.ndarray:
        top = rows.groupBy(key).agg(F.sum("count").alias("count")).orderBy(F.desc("count"), key).limit(most).collect()
        return np.array([r[key] for r in top], np.int64)

    words = counts.filter(F.col("word") != END)
    top = frequent(words, "word", WORD_CLASSES)
    ends = np.sort(frequent(words.filter(~F.col("word").isin(top.tolist())), "ending", ENDING_CLASSES))
    own = np.sort(top.view(np.uint64))
    return Classes(own, 1 + np.arange(len(own)), ends, 1 + len(own) + np.arange(len(ends)))


class Recurrent:
    """Gated recurrent unit over classes; the input n_classes begins a text."""

    def __init__(self, n_classes: int, hidden: int = HIDDEN, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.n, self.hidden = n_classes, hidden
        scale = 1 / np.sqrt(hidden)
        self.p = {
            "input": rng.normal(0, 0.3, (n_classes + 1, 3 * hidden)).astype(np.float32),
            "state": rng.normal(0, scale, (hidden, 3 * hidden)).astype(np.float32),
            "out": rng.normal(0, 0.1, (hidden, n_classes)).astype(np.float32),
            "bias": np.zeros(n_classes, np.float32),
        }

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        k = self.hidden
        a, new = h @ self.p["state"], self.p["input"][x]
        gate = new[:, : 2 * k] + a[:, : 2 * k]
        np.negative(gate, out=gate)
        np.exp(gate, out=gate)
        gate += 1
        np.reciprocal(gate, out=gate)  # the logistic function
        z, r, a = gate[:, :k], gate[:, k:], a[:, 2 * k :]
        n = r * a
        n += new[:, 2 * k :]
        np.tanh(n, out=n)
        new = h - n
        new *= z
        new += n
        return new, z, r, n, a

    def _plain(self) -> bool:
        """Whether no logit can exceed 80, as a state lies between -1 and 1; then exp needs no guard."""
        return float((np.abs(self.p["out"]).sum(0) + self.p["bias"]).max()) < 80

    def _out(self) -> np.ndarray:
        """The weights of the logits, with the bias as those of one more state, which is 1."""
        return np.vstack([self.p["out"], self.p["bias"]])

    def log_class(self, h: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Natural logarithm of the probability of class y in state h."""
        h = np.hstack([h, np.ones((len(h), 1), h.dtype)])
        got, out, ones, plain = np.empty(len(y)), self._out(), np.ones(self.n, np.float32), self._plain()
        for i in range(0, len(y), ROWS_AT_ONCE):
            logit = h[i : i + ROWS_AT_ONCE] @ out
            own = logit[np.arange(len(logit)), y[i : i + ROWS_AT_ONCE]]
            if not plain:
                np.minimum(logit, 80, out=logit)
            np.exp(logit, out=logit)
            got[i : i + ROWS_AT_ONCE] = own - np.log(logit @ ones)
        return got

    def score(self, classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log probability of each text's classes; texts lie one after the other in ``classes``."""
        order = np.argsort(-lengths, kind="stable")
        start = (np.cumsum(lengths) - lengths)[order]
        size = lengths[order]
        total = np.zeros(len(lengths))
        h = np.zeros((len(lengths), self.hidden), np.float32)
        x = np.full(len(lengths), self.n)
        longest = int(size[0]) if len(size) else 0
        for t0 in range(0, longest, WINDOW):
            states, targets, rows = [], [], []
            for t in range(t0, min(t0 + WINDOW, longest)):
                m = int(np.searchsorted(-size, -t, side="left"))  # texts longer than t
                h = self.step(x[:m], h[:m])[0]
                x = classes.take(start[:m] + t)
                states.append(h)
                targets.append(x)
                rows.append(np.arange(m))
            got = self.log_class(np.concatenate(states), np.concatenate(targets))
            total += np.bincount(np.concatenate(rows), weights=got, minlength=len(total))
        out = np.empty(len(lengths))
        out[order] = total
        return out

    def fit(self, texts: list[np.ndarray], epochs: int = 2, streams: int = 32, window: int = 32, rate: float = 0.01, seed: int = 0) -> None:
        """Truncated backpropagation: texts laid end to end in parallel streams, state carried between windows."""
        if not texts:
            return
        rng = np.random.default_rng(seed)
        share = np.bincount(np.concatenate(texts), minlength=self.n) + 1.0
        self.p["bias"] = np.log(share / share.sum()).astype(np.float32)
        self._restart()
        for _ in range(epochs):
            xs, ys = self._laid(np.concatenate([texts[i] for i in rng.permutation(len(texts))]), streams)
            h = np.zeros((streams, self.hidden), np.float32)
            total = epochs * -(-xs.shape[1] // window)
            for a in range(0, xs.shape[1], window):
                grad, h = self._window(xs[:, a : a + window], ys[:, a : a + window], h)
                self._descend(grad, rate * (1 - self.done / total) + 1e-4)

    def go_on(self, classes: np.ndarray, streams: int = 128, window: int = 32, rate: float = ROUND_RATE) -> None:
        """One more pass over texts laid end to end; the step sizes of earlier passes are kept."""
        streams = max(1, min(streams, len(classes) // window))
        xs, ys = self._laid(classes, streams)
        h = np.zeros((streams, self.hidden), np.float32)
        for a in range(0, xs.shape[1], window):
            grad, h = self._window(xs[:, a : a + window], ys[:, a : a + window], h)
            self._descend(grad, rate)

    def _laid(self, flat_y: np.ndarray, streams: int) -> tuple[np.ndarray, np.ndarray]:
        """Inputs and targets by stream."""
        first = flat_y * 0
        first[0] = 1
        first[1:] = flat_y[:-1] == 0  # after an end, a text begins
        flat_x = np.where(first == 1, self.n, np.concatenate([[self.n], flat_y[:-1]]))
        width = -(-len(flat_y) // streams)
        pad = streams * width - len(flat_y)
        xs, ys = (np.concatenate([a, a[:pad] if pad <= len(a) else np.resize(a, pad)]).reshape(streams, width) for a in (flat_x, flat_y))
        return xs, ys

    def _restart(self) -> None:
        self.mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.square = {k: np.zeros_like(v) for k, v in self.p.items()}
        self.done = 0

    def _descend(self, grad: dict[str, np.ndarray], speed: float) -> None:
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        self.done += 1
        for k, g in grad.items():
            g *= min(1.0, 1.0 / (norm + 1e-9))
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.01 * (g * g - self.square[k])
            step = speed * (self.mean[k] / (1 - 0.9**self.done)) / (np.sqrt(self.square[k] / (1 - 0.99**self.done)) + 1e-8)
            self.p[k] -= step.astype(np.float32)

    def _window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean loss over one window, and the state at its end."""
        k, steps, width = self.hidden, x.shape[1], len(h)
        begun = (x.T != self.n)[:, None, :].astype(np.float32)
        # by step, gate and stream: what is worked on together is contiguous
        new = np.ascontiguousarray(self.p["input"].take(x.T, 0).transpose(0, 2, 1))
        into, down = np.ascontiguousarray(self.p["state"].T), np.ascontiguousarray(self.p["state"])
        new[:, : 2 * k] *= -1
        into[: 2 * k] *= -1
        before, n, states = (np.empty((steps, k, width), np.float32) for _ in range(3))
        gates = np.empty((steps, 3 * k, width), np.float32)
        h = np.ascontiguousarray(h.T)
        for t in range(steps):
            at, own, out = before[t], gates[t], n[t]
            np.multiply(h, begun[t], out=at)
            np.matmul(into, at, out=own)
            both = own[: 2 * k]
            both += new[t, : 2 * k]
            np.exp(both, out=both)
            both += 1
            np.reciprocal(both, out=both)  # the logistic function
            np.multiply(own[k : 2 * k], own[2 * k :], out=out)
            out += new[t, 2 * k :]
            np.tanh(out, out=out)
            h = np.subtract(at, out, out=states[t])
            h *= own[:k]
            h += out
        z, r, a = gates[:, :k].copy(), gates[:, k : 2 * k].copy(), gates[:, 2 * k :]
        flat = np.ones((steps * width, k + 1), np.float32)  # the last column is for the bias
        flat[:, :k] = states.transpose(0, 2, 1).reshape(-1, k)
        target, out = y.T.reshape(-1), self._out()
        to_state, ones = np.ascontiguousarray(self.p["out"].T), np.ones((self.n, 1), np.float32)
        from_out, to_out, plain = np.empty((len(flat), k), np.float32), np.zeros_like(out), self._plain()
        for i in range(0, len(flat), ROWS_AT_ONCE):
            some, aims = flat[i : i + ROWS_AT_ONCE], target[i : i + ROWS_AT_ONCE]
            p = some @ out
            if not plain:
                p -= p.max(1, keepdims=True)
            np.exp(p, out=p)
            total = p @ ones
            p[np.arange(len(aims)), aims] -= total[:, 0]  # times scale, these are the gradients of the logits
            scale = 1 / (total * np.float32(len(target)))
            to_out += (some * scale).T @ p
            np.multiply(p @ to_state, scale, out=from_out[i : i + ROWS_AT_ONCE])
        grad = {"out": to_out[:k], "bias": to_out[k]}
        from_out = np.ascontiguousarray(from_out.reshape(steps, width, k).transpose(0, 2, 1))
        # what does not depend on later steps, for the whole window at once
        keep = 1 - z
        to_z = before - n
        to_z *= z
        to_z *= keep
        to_n = n * n
        np.subtract(1, to_n, out=to_n)
        to_n *= keep
        to_r = 1 - r
        to_r *= r
        to_r *= a
        inner, back = np.empty_like(states), np.zeros_like(h)
        for t in range(steps - 1, -1, -1):
            dh, own = from_out[t], gates[t]
            dh += back
            np.multiply(dh, to_z[t], out=own[:k])
            dn = np.multiply(dh, to_n[t], out=inner[t])
            np.multiply(dn, to_r[t], out=own[k : 2 * k])
            np.multiply(dn, r[t], out=own[2 * k :])
            np.matmul(down, own, out=back)
            dh *= z[t]
            back += dh
            back *= begun[t]
        grad["state"] = before.transpose(1, 0, 2).reshape(k, -1) @ gates.transpose(1, 0, 2).reshape(3 * k, -1).T
        gates[:, 2 * k :] = inner
        grad["input"] = np.zeros_like(self.p["input"])
        used, order = x.T.reshape(-1), gates.transpose(0, 2, 1).reshape(-1, 3 * k)
        by = np.argsort(used, kind="stable")
        starts = np.flatnonzero(np.diff(used[by], prepend=-1))
        grad["input"][used[by][starts]] = np.add.reduceat(order.take(by, 0), starts)
        return grad, h.T


@dataclass
class Model:
    classes: Classes
    net: Recurrent
    head: np.ndarray  # sorted hashes of the most frequent words
    head_log: np.ndarray  # log10(count + 1)
    end_log: float
    mass_log: np.ndarray  # by class: log10 of the sum of count + 1
    train_tokens: int
    vocabulary: int
    fitted: int  # tokens that the rounds over all texts went through


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def _some(texts: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[list[tuple[np.ndarray, np.ndarray]]]:
    """The texts in lists of about ``WORDS_AT_ONCE`` words, which bounds the memory of a task."""
    held, size = [], 0
    for both in texts:
        held.append(both)
        size += len(both[0])
        if size > WORDS_AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _counts(texts: DataFrame) -> DataFrame:
    """(word, ending, count) over all ``texts``; counted by batch before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for both in _some(words_and_ends(batch.column(0).to_pylist())):
                words = np.concatenate([w for w, _ in both])
                word, first, count = np.unique(words, return_index=True, return_counts=True)
                ending = np.concatenate([e for _, e in both])[first]
                word, ending, count = np.append(word, np.uint64(END)), np.append(ending, -1), np.append(count, len(both))
                yield pa.record_batch([pa.array(word.view(np.int64)), pa.array(ending), pa.array(count)], names=["word", "ending", "count"])

    rows = texts.mapInArrow(run, "word long, ending long, count long")
    return rows.groupBy("word", "ending").agg(F.sum("count").alias("count"))


def _sample(texts: DataFrame, share: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Words and endings of windows of texts, each drawn with the probability ``share``; a text's last one has its end, -1."""
    bar = np.uint64(min(int(share * (1 << 32)), (1 << 32) - 1))

    def drawn(at: int, n_words: int) -> np.ndarray:
        starts = np.arange(0, n_words + 1, SAMPLE_WINDOW)
        return starts[mix(np.uint64(at % (1 << 64)) ^ mix(starts.astype(np.uint64) + np.uint64(1))) >> np.uint64(32) <= bar]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            # a text of so many characters has at most one word for two of them, so one without such a window has none drawn
            some = [i for i, t in enumerate(texts) if drawn(ids[i], (len(t or "") + 1) // 2).size]
            for at, (words, endings) in zip([ids[i] for i in some], words_and_ends([texts[i] for i in some]), strict=True):
                for i in drawn(at, len(words)):
                    w, e = words[i : i + SAMPLE_WINDOW].view(np.int64), endings[i : i + SAMPLE_WINDOW]
                    if i + SAMPLE_WINDOW > len(words):
                        w, e = np.append(w, np.int64(END)), np.append(e, -1)
                    yield pa.record_batch(
                        [pa.array([at]), pa.array([i]), pa.array([w.tolist()], pa.list_(pa.int64())), pa.array([e.tolist()], pa.list_(pa.int64()))],
                        names=["at", "i", "words", "endings"],
                    )

    rows = texts.select("at", "text").mapInArrow(run, "at long, i long, words array<long>, endings array<long>").collect()
    rows.sort(key=lambda r: (r["at"], r["i"]))
    return [np.array(r["words"], np.int64).view(np.uint64) for r in rows], [np.array(r["endings"], np.int64) for r in rows]


def _read(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all texts of a column, one after the other, and the texts' lengths."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.int16), np.zeros(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 2
    return np.frombuffer(column.buffers()[2], np.int16, int(offsets[-1]))[offsets[0] :], np.diff(offsets)


def _round(coded: DataFrame, net: Recurrent) -> int:
    """``net`` goes on over the texts ``coded`` in every task; the weights are averaged by tokens. Returns the tokens."""
    names = sorted(net.p)
    shared = coded.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = shared.value
        own, tokens = copy.deepcopy(start), 0
        own._restart()
        for batch in batches:
            classes, lengths = _read(batch.column(0))
            ends = np.cumsum(lengths)
            at = 0
            while at < len(classes):  # whole texts, about WORDS_AT_ONCE tokens
                upto = int(ends[min(np.searchsorted(ends, at + WORDS_AT_ONCE), len(ends) - 1)])
                own.go_on(classes[at:upto].astype(np.int64))
                tokens += upto - at
                at = upto
        if tokens:
            flat = np.concatenate([own.p[k].reshape(-1) for k in names]).astype(np.float64) * tokens
            flat = np.append(flat, tokens)
            yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "value"])

    rows = coded.select("classes").mapInArrow(run, "place long, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    shared.unpersist()
    if not rows.num_rows:
        return 0
    value = rows["value"].to_numpy()[np.argsort(rows["place"].to_numpy())]
    at = 0
    for k in names:
        size = net.p[k].size
        net.p[k] = (value[at : at + size] / value[-1]).astype(np.float32).reshape(net.p[k].shape)
        at += size
    return int(value[-1])


def _tally(rows: DataFrame, head: int, seed: int) -> tuple[Model, DataFrame]:
    """The model before it is trained, and all counts; ``rows``: the training texts."""
    counts = cut(_counts(rows.select("text")), "counts", TEXTS_AT_ONCE)
    n, v = counts.agg(F.sum("count"), F.count("*")).first()
    classes = choose_classes(counts)
    shared = rows.sparkSession.sparkContext.broadcast(classes)

    def by_class(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word, ending, count = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            of = shared.value.of(word.view(np.uint64), ending)
            of[word == np.int64(END)] = 0
            mass = np.bincount(of, weights=count + 1.0, minlength=shared.value.n)
            yield pa.record_batch([pa.array(np.arange(len(mass))), pa.array(mass)], names=["class", "mass"])

    mass = np.zeros(classes.n)
    for r in counts.mapInArrow(by_class, "class long, mass double").groupBy("class").agg(F.sum("mass").alias("mass")).collect():
        mass[r["class"]] = r["mass"]
    mass[1 + len(classes.words) :] += 1  # a word never met
    top = counts.filter(F.col("word") != END).orderBy(F.desc("count"), "word").limit(head).select("word", "count").toArrow()
    word, count = top["word"].to_numpy().view(np.uint64), top["count"].to_numpy()
    order = np.argsort(word)
    end = counts.filter(F.col("word") == END).select("count").first()
    end_log = float(np.log10((end[0] if end else 0) + 1.0))
    net = Recurrent(classes.n, seed=seed)
    return Model(classes, net, word[order], np.log10(count[order] + 1.0), end_log, np.log10(np.maximum(mass, 1)), int(n or 0), int(v), 0), counts


def _fit(model: Model, rows: DataFrame, coded: DataFrame, fit_tokens: int, seed: int) -> None:
    """Trains the network of ``model``; ``rows``: at, text of the training texts, ``coded``: at, classes of these."""
    n, of = model.train_tokens, model.classes.of
    words, endings = _sample(rows, min(1.0, fit_tokens / n)) if n else ([], [])
    model.net.fit([np.where(e == -1, 0, of(w, e)) for w, e in zip(words, endings, strict=True)], seed=seed)
    part = F.pmod(F.xxhash64(F.col("at"), F.lit("language model round")), F.lit(ROUNDS))
    model.fitted = sum(_round(coded.filter(part == i), model.net) for i in range(ROUNDS)) if n else 0


def train(rows: DataFrame, fit_tokens: int = FIT_TOKENS, head: int = HEAD, seed: int = 0) -> tuple[Model, DataFrame]:
    """The model and all counts; ``rows``: at, text of the training texts."""
    ship(rows.sparkSession)
    model, counts = _tally(rows, head, seed)
    _fit(model, rows, cut(_coded(rows.select("at", "text"), model), "coded", TEXTS_AT_ONCE), fit_tokens, seed)
    return model, counts


def _sums(m: Model, both: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """By text: tokens, known and logs of the head, logs of class sums; classes of all tokens; number of other words, and these."""
    sizes = np.array([len(w) for w, _ in both])
    words, owner = np.concatenate([w for w, _ in both]), np.repeat(np.arange(len(both)), sizes)
    classes = np.zeros(len(words) + len(both), np.int16)  # class 0 where a text ends
    classes[np.arange(len(words)) + owner] = m.classes.of(words, np.concatenate([e for _, e in both]))
    mass = np.bincount(np.repeat(np.arange(len(both)), sizes + 1), weights=m.mass_log[classes], minlength=len(both))
    hit, logs = np.zeros(len(words), bool), np.full(len(both), m.end_log)
    if len(m.head):
        at = np.minimum(np.searchsorted(m.head, words), len(m.head) - 1)
        hit = m.head[at] == words
        logs += np.bincount(owner[hit], weights=m.head_log[at[hit]], minlength=len(both))
    known = np.bincount(owner[hit], minlength=len(both)) + int(m.end_log > 0)
    return sizes + 1, known, logs, mass, classes, np.bincount(owner[~hit], minlength=len(both)), words[~hit].view(np.int64)


def _coded(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with, for the text, n_tokens, known, logs, mass: sums over the tokens; tail: words beyond the head; classes (16 bits each)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            parts = [_sums(m, both) for both in _some(words_and_ends(batch.column(len(kept)).to_pylist()))]
            if not parts:
                continue
            sizes, known, logs, mass, classes, tails, tail = (np.concatenate(x) for x in zip(*parts, strict=True))
            offsets = np.concatenate([[0], np.cumsum(tails)]).astype(np.int32)
            places = np.concatenate([[0], np.cumsum(2 * sizes)]).astype(np.int32)
            coded = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(places), pa.py_buffer(classes)])
            yield pa.record_batch(
                [*batch.columns[: len(kept)], *map(pa.array, (sizes, known, logs, mass)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(tail)), coded],
                names=[*kept, "n_tokens", "known", "logs", "mass", "tail", "classes"],
            )

    own = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in kept)
    schema = f"{own}n_tokens long, known long, logs double, mass double, tail array<long>, classes binary"
    return rows.select(*kept, "text").mapInArrow(run, schema)


def _scored(coded: DataFrame, net: Recurrent) -> DataFrame:
    """at, own: log10 probability of a text's classes; one row for repeated rows, whose sums differ by rounding."""
    shared = coded.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = shared.value.score(*_read(batch.column(1))) / np.log(10)
            yield pa.record_batch([batch.column(0), pa.array(own)], names=["at", "own"])

    rows = coded.select("at", "classes").mapInArrow(run, "at long, own double")
    return rows.groupBy("at").agg(F.min("own").alias("own"))


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_tokens: int = FIT_TOKENS, head: int = HEAD, seed: int = 0
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score; learns from the rows not held out."""
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.xxhash64(id_col, text_col).alias("at"), F.col(text_col).alias("text"))
    ship(rows.sparkSession)
    learnt = rows.filter(~F.col("held_out")).select("at", "text")
    model, counts = _tally(learnt, head, seed)
    coded = cut(_coded(rows, model), "coded", TEXTS_AT_ONCE)
    _fit(model, learnt, coded.filter(~F.col("held_out")).select("at", "classes"), fit_tokens, seed)
    scored = cut(_scored(coded, model.net), "scored", TEXTS_AT_ONCE)
    known = counts.select("word", F.log10(F.col("count") + 1).alias("log"))
    tails = (
        coded.dropDuplicates(["at"])
        .select("at", F.explode("tail").alias("word"))
        .join(known, "word")
        .groupBy("at")
        .agg(F.count("*").alias("tail_known"), F.sum("log").alias("tail_log"))
    )
    logs = F.col("logs") + F.coalesce("tail_log", F.lit(0.0))
    return coded.drop("tail", "classes").join(scored, "at").join(tails, "at", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(model.train_tokens + model.vocabulary + 1)))).alias("base_score"),
        (logs + F.col("own") - F.col("mass")).alias("score"),
    )
