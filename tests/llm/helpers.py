"""Small tables and brute-force versions for the corpus operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Columns whose names operators use inside.
CLASHING = ("set", "at", "key", "slot", "shard", "size", "_id", "_row", "line", "word", "row", "bucket", "position", "ids", "sid")


def documents(spark, rows, parts: int = 3):
    """Table of (doc_id, text[, lang[, source]]) with extra columns of clashing names."""
    full = [(*r, *("en", "s0")[len(r) - 2 :]) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string").repartition(parts)
    return df.selectExpr("*", *[f"'extra' as `{c}`" for c in CLASHING])


def awkward() -> list[tuple]:
    """Null ids and texts, empty and blank texts, repeated rows, ties, one long text."""
    return [
        (1, "One two three four five six seven eight.\nShort line."),
        (1, "One two three four five six seven eight.\nShort line."),
        (2, None),
        (3, ""),
        (4, " \t\n\x0b\r\f "),
        (None, "A text without an id, of some words."),
        (None, None),
        (5, "Éa 日本語 \U0001f600 ß İ"),
        (6, "long " * 20000 + "end"),
        (7, "One two three four five six seven eight.\nShort line. "),
    ]


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingle_sets(texts, k: int) -> list[set]:
    out = []
    for t in texts:
        w = WORD.findall(lowered(t))
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def components(ids: list, texts: list, k: int, percent: int) -> dict:
    """(set size, smallest id of the component) by id, from all pairs."""
    sets = shingle_sets(texts, k)
    up = list(range(len(ids)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least: dict = {}
    for i in range(len(ids)):
        least.setdefault(top(i), []).append(ids[i])
    return {ids[i]: (len(sets[i]), min(least[top(i)]) if sets[i] else ids[i]) for i in range(len(ids))}


def varied(words: list[str], edits: int, rng: random.Random) -> list[str]:
    words = list(words)
    for _ in range(edits):
        i, r = rng.randrange(len(words)), rng.random()
        if r < 0.5:
            words[i] = f"v{rng.randrange(50)}"
        elif r < 0.75:
            words.insert(i, f"z{rng.randrange(9)}")
        elif len(words) > 1:
            del words[i]
    return words
