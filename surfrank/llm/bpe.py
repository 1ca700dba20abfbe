"""Byte-level BPE encoding and decoding with a lazily determinised transducer.

Encoding.  A piece of text (a match of the split pattern) that is itself a
token is that token.  Any other piece runs byte by byte through a
finite-state transducer.  The merges leave exactly one token that can end
at each byte: the token t for which the pair (last token before t, t) stays
apart when its bytes are merged by rank.  A state holds every open start (a
suffix that some longer token begins with, as a trie node), the last token before it, and
the tokens not yet emitted on the way to it.  What all open starts have in
common cannot change any more and is emitted, so the lookahead is bounded
by the longest token and a piece of any length takes linear time and little
memory.  States and transitions are made when first met and kept; the
tables are bounded and start anew when full, which changes no result; a worker
without such a task for ``IDLE_SECONDS`` frees them.

Decoding joins token bytes in chunks; an incremental UTF-8 state machine
holds back the bytes of an unfinished character at a chunk's end.

Texts are dealt out by Spark as they lie in the input; a task handles some
texts at a time and there is no shuffle.  The rank file is read once on the
driver and broadcast (its size is that of the vocabulary).

Cases: null text counts as empty and gives no tokens; repeated rows give
repeated results; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib
import threading
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

MAX_STATES = 200_000
MAX_PIECES = 600_000
CHUNK = 8192
GROUP_CHARS = 1 << 21
LONG_PIECE = 64
IDLE_SECONDS = 1.0


def load_ranks(path: str) -> bytes:
    """The rank file (lines of base64 token, blank, rank) as it is."""
    with open(path, "rb") as f:
        return f.read()


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line)}


class Transducer:
    """Encodes pieces of bytes; see the module's docstring."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        # trie of the tokens: child by (node << 8 | byte), token and whether longer ones follow by node
        self.child: dict[int, int] = {}
        self.ends: list[int | None] = [None]
        self.inner: list[bool] = [True]
        for t, r in ranks.items():
            node = 0
            for byte in t:
                self.inner[node] = True
                node = self.child.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(None)
                    self.inner.append(False)
            self.ends[node] = r
        self.max_states = max_states
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.ids: dict[tuple, int] = {}
        self.live: list[tuple] = []
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.start = self._state(((0, -1, ()),))

    def _state(self, live: tuple) -> int:
        at = self.ids.get(live)
        if at is None:
            at = self.ids[live] = len(self.live)
            self.live.append(live)
        return at

    def merged(self, data: bytes, stop: int = 1 << 60) -> list[int]:
        """Tokens of ``data`` by merging the pair of lowest rank, leftmost first; only merges below ``stop``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if best[0] >= stop:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes t; None for a byte, or a token that merging never makes."""
        got = self.halves.get(t, t)
        if got == t:
            data, got = self.token[t], None
            if len(data) > 1:
                parts = self.merged(data, stop=t)
                got = (parts[0], parts[1]) if len(parts) == 2 and self.ranks.get(data) == t else None
            self.halves[t] = got
        return got

    def _apart(self, a: int, b: int) -> bool:
        """Whether token b can follow token a (-1: stand first).

        Merges are undone from the last made to the first.  While x ends
        the left and y begins the right side, xy must not be a merge that
        comes before the one that took x or y away; of equal ranks the left
        comes first.
        """
        if len(self.token[b]) > 1 and self._halves(b) is None:
            return False  # only a whole piece can be this token
        if a < 0:
            return True
        x, y, until, token, ranks = a, b, 1 << 60, self.token, self.ranks
        while True:
            if ranks.get(token[x] + token[y], 1 << 60) < until:
                return False
            left, right = self._halves(x), self._halves(y)
            if left is None and right is None:
                return True
            if right is None or left is not None and x > y:
                until, x = x, left[1]
            else:
                until, y = y + 1, right[0]

    def _follows(self, a: int, b: int) -> bool:
        """``_apart``, kept."""
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            if len(self.pairs) > self.max_states:
                self.pairs.clear()
            got = self.pairs[key] = self._apart(a, b)
        return got

    def _ended(self, live: tuple, byte: int) -> tuple:
        """The token that ends with ``byte``, and all tokens not emitted up to it."""
        child, ends = self.child, self.ends
        for node, last, made in live:
            node = child.get(node << 8 | byte)
            if node is not None and (t := ends[node]) is not None:
                apart = self.pairs.get(last << 32 | t)
                if apart is None:
                    apart = self._follows(last, t)
                if apart:
                    return 0, t, (*made, t)
        raise ValueError("the ranks have no token for a byte")

    def _move(self, at: int, byte: int) -> tuple[int, tuple[int, ...]]:
        child, inner, live = self.child, self.inner, self.live[at]
        ended = self._ended(live, byte)
        live = [(n, last, made) for node, last, made in live if (n := child.get(node << 8 | byte)) is not None and inner[n]]
        out = ended[2]
        for _, _, made in live:  # what all open starts have in common
            n = 0
            for x, y in zip(out, made, strict=False):
                if x != y:
                    break
                n += 1
            out = out[:n]
        live.append(ended)
        if n := len(out):
            live = [(s, last, made[n:]) for s, last, made in live]
        got = self.moves[at << 8 | byte] = self._state(tuple(live)), out
        return got

    def encode(self, piece: bytes) -> Iterator[int]:
        """Tokens of a piece, each as soon as it is settled."""
        if (whole := self.ranks.get(piece)) is not None:
            yield whole
            return
        at = self.live[self.start]
        for i in range(0, len(piece), CHUNK):
            out, at = self._run(piece[i : i + CHUNK], at)
            yield from out
        yield from at[-1][2]

    def encode_sorted(self, pieces: Iterable[bytes]) -> Iterator[tuple[int, ...]]:
        """Tokens of each of some sorted pieces; each goes on from the state that its prefix has in common with the one before."""
        before, path, made = b"", [], []
        for piece in pieces:
            if (whole := self.ranks.get(piece)) is not None:
                yield (whole,)
                continue
            if len(piece) > LONG_PIECE:
                yield tuple(self.encode(piece))
                before, path = b"", []
                continue
            if not path or len(self.live) > self.max_states:
                if len(self.live) > self.max_states:
                    self._reset()
                before, path, made = b"", [self.start], [()]
            i, most = 0, min(len(before), len(piece)) - 1
            while i < most and before[i] == piece[i]:
                i += 1
            del path[i + 1 :], made[i + 1 :]
            at, out, before = path[i], made[i], piece
            for byte in piece[i:-1]:
                got = self.moves.get(at << 8 | byte)
                if got is None:
                    got = self._move(at, byte)
                at = got[0]
                if got[1]:
                    out += got[1]
                path.append(at)
                made.append(out)
            yield out + self._ended(self.live[at], piece[-1])[2]  # the state after the last byte is not needed

    def _run(self, data: bytes, live: tuple) -> tuple[list[int], tuple]:
        """Tokens emitted over ``data`` from a state, and the state after it."""
        if len(self.live) > self.max_states:
            self._reset()
        at, moves, out = self._state(live), self.moves, []
        for byte in data:
            got = moves.get(at << 8 | byte)
            if got is None:
                got = self._move(at, byte)
            at = got[0]
            if got[1]:
                out += got[1]
        return out, self.live[at]


class Utf8Stream:
    """Incremental UTF-8: gives whole characters, holds back an unfinished one."""

    #: First bytes of a character of 1 to 4 bytes.
    LEADS = ((0x00, 0x7F), (0xC2, 0xDF), (0xE0, 0xEF), (0xF0, 0xF4))

    def __init__(self):
        self.held = b""
        self.need = {b: n for n, (a, z) in enumerate(self.LEADS, 1) for b in range(a, z + 1)}

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):
            if (b := data[-back]) & 0xC0 != 0x80:  # not a continuation byte
                if self.need.get(b, 1) > back:
                    cut -= back
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8", "replace")


class Codec:
    """Whole texts to ids and back."""

    def __init__(self, ranks: bytes, pattern: str):
        import regex

        # \s means Unicode's white space, as in the library that the rank files are made for
        self.split = regex.compile(pattern)
        self.transducer = Transducer(parse_ranks(ranks))
        self.pieces: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        return next(self.encode_many([text]))

    def encode_many(self, texts: Iterable[str]) -> Iterator[list[int]]:
        """Ids of each text; the new pieces of some texts together are encoded in sorted order."""
        held: list[list[str]] = []
        size = 0
        for text in texts:
            if len(text) > GROUP_CHARS:
                yield from self._ids(held)
                held, size = [], 0
                yield self._long(text)
                continue
            held.append(self.split.findall(text))
            size += len(text)
            if size > GROUP_CHARS:
                yield from self._ids(held)
                held, size = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[str]]) -> Iterator[list[int]]:
        if len(self.pieces) > MAX_PIECES:
            self.pieces.clear()
        new = sorted((p.encode(), p) for p in set().union(*held) if p not in self.pieces)
        for (_, piece), ids in zip(new, self.transducer.encode_sorted(data for data, _ in new), strict=True):
            self.pieces[piece] = ids
        for found in held:
            yield list(chain.from_iterable(map(self.pieces.__getitem__, found)))

    def _long(self, text: str) -> list[int]:
        out: list[int] = []
        for m in self.split.finditer(text):
            out += self.pieces.get(m.group()) or self.transducer.encode(m.group().encode())
        return out

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        stream, ids, token = Utf8Stream(), iter(ids), self.transducer.token
        while some := list(islice(ids, CHUNK)):
            yield stream.feed(b"".join(map(token.__getitem__, some)))
        yield stream.end()


_CODECS: dict[tuple[int, str], Codec] = {}
_LETTING_GO: list[threading.Timer] = []


def _codec(shared, pattern: str) -> Codec:
    """One codec for each rank file in a Python worker; its tables are kept between tasks that follow each other."""
    while _LETTING_GO:
        _LETTING_GO.pop().cancel()
    raw = shared.value
    key = (hash(raw), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(raw, pattern)
    return _CODECS[key]


def _let_go() -> None:
    """Free the tables soon, unless another task comes: a reused worker may go on with a stage that has no use for them."""
    timer = threading.Timer(IDLE_SECONDS, _CODECS.clear)
    timer.daemon = True
    _LETTING_GO.append(timer)
    timer.start()


def _map(df: DataFrame, ranks: str, pattern: str, columns: list, schema: str, of) -> DataFrame:
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(load_ranks(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, pattern)
        try:
            for batch in batches:
                yield of(codec, batch)
        finally:
            _let_go()

    return df.select(*columns).mapInArrow(run, schema)


def encode(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int)."""

    def of(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = list(codec.encode_many(t or "" for t in batch.column(1).to_pylist()))
        return pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    return _map(docs, ranks, pattern, [F.col(id_col), F.col(text_col)], f"doc_id {kind}, ids array<int>", of)


def decode(tokens: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, text of a result of ``encode``."""

    def of(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["".join(codec.decode(i or ())) for i in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return _map(tokens, ranks, pattern, ["doc_id", "ids"], f"doc_id {kind}, text string", of)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encodes each text and decodes the ids again."""

    def of(codec: Codec, batch: pa.RecordBatch) -> pa.RecordBatch:
        names = {r: str(r) for r in codec.transducer.token} if not hasattr(codec, "names") else codec.names
        codec.names = names
        n, told, back = [], [], []
        for ids in codec.encode_many(batch.column(1)[i].as_py() or "" for i in range(batch.num_rows)):
            n.append(len(ids))
            told.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
            digest = hashlib.sha256()
            for part in codec.decode(ids):
                digest.update(part.encode())
            back.append(digest.hexdigest())
        return pa.record_batch(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(told, pa.string()), pa.array(back, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _map(docs, ranks, pattern, [F.col(id_col), F.col(text_col)], schema, of)
