from __future__ import annotations

import hashlib
import random
import re

import pytest

from surfrank.llm import exact_dedup, jaccard_join, line_dedup
from tests.llm.helpers import awkward, components, documents, varied


def one_edit(a, b) -> bool:
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    if len(a) < len(b):
        a, b = b, a
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def lines_brute(docs, min_words=8):
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0))
    seen, out = [], {}
    for i in order:
        doc_id, text = docs[i]
        if text is None:
            out[doc_id] = (0, 0, 0, None)
            continue
        kept, n, equal, alike = [], 0, 0, 0
        for line in text.split("\n"):
            w = tuple(x for x in re.split(r"[\x20\x09-\x0D]+", line) if x)
            if not w:
                kept.append(line)
                continue
            n += 1
            if w in seen:
                equal += 1
                continue
            if len(w) >= min_words and any(len(o) >= min_words and one_edit(w, o) for o in seen):
                alike += 1
            else:
                kept.append(line)
            seen.append(w)
        out[doc_id] = (n, equal, alike, "\n".join(kept))
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(30)}" for _ in range(rng.choice([1, 3, 7, 8, 9, 10, 15, 30]))] for _ in range(25)]

    def line():
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            i, r = rng.randrange(len(w) + 1), rng.random()
            if r < 0.4 and i < len(w):
                w[i] = f"x{rng.randrange(5)}"
            elif r < 0.7:
                w.insert(i, rng.choice(["y", "w1", w[min(i, len(w) - 1)]]))
            elif i < len(w) and len(w) > 1:
                del w[i]
        return rng.choice([" ", "  ", "\t"]).join(w)

    docs = [(i, "\n".join(rng.choice([line(), line(), line(), "", " "]) for _ in range(rng.randrange(1, 12)))) for i in range(120)]
    docs += [(900, None), (901, ""), (902, "\n\n"), (None, docs[3][1]), (903, " ".join(["many words"] * 3000))]
    got = {r.doc_id: (r.n_lines, r.n_equal, r.n_alike, r.text) for r in line_dedup.dedup(documents(spark, docs)).collect()}
    assert got == lines_brute(docs)


def words_apart(a, b) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def test_line_dedup_bound_grows_with_the_length(spark):
    """One word in ten may differ; the number of edits lies on both sides of the bound."""
    rng = random.Random(11)
    base = [[f"w{rng.randrange(200)}" for _ in range(n)] for n in (5, 8, 12, 19, 20, 21, 29, 30, 45, 60, 88, 90, 99, 100, 130) for _ in range(2)]
    base += [["same", "words"] * 20, ["a", "b", "c"] * 35]
    seen, docs = [], []
    for i in range(90):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            w = list(rng.choice(base))
            for _ in range(rng.randrange(0, max(2, len(w) // 10) + 2)):
                at, r = rng.randrange(len(w)), rng.random()
                if r < 0.4:
                    w[at] = f"x{rng.randrange(9)}"
                elif r < 0.7:
                    w.insert(at, f"w{rng.randrange(200)}")
                else:
                    del w[at]
            lines.append(" ".join(w))
        docs.append((i, "\n".join(lines)))
    want = {}
    for i, text in docs:
        kept, equal, alike = [], 0, 0
        for line in text.split("\n"):
            w = line.split(" ")
            if w in seen:
                equal += 1
                continue
            if any(min(len(w), len(o)) >= 8 and abs(len(w) - len(o)) < 20 and words_apart(w, o) <= max(1, min(len(w), len(o)) // 10) for o in seen):
                alike += 1
            else:
                kept.append(line)
            seen.append(w)
        want[i] = (equal, alike, "\n".join(kept))
    got = line_dedup.dedup(documents(spark, docs), words_per_edit=10).collect()
    assert {r.doc_id: (r.n_equal, r.n_alike, r.text) for r in got} == want
    one_word = line_dedup.dedup(documents(spark, docs)).collect()
    assert sum(r.n_alike for r in one_word) < sum(alike for _, alike, _ in want.values())


def test_line_dedup_lines_of_one_passage_are_not_paired(spark):
    """Of lines that share a passage of ten words in forty few have a key; two lines two words apart share one."""
    rng = random.Random(3)

    def fresh(n):
        return [f"w{rng.randrange(10**9)}" for _ in range(n)]

    passage = fresh(10)
    lines = [fresh(15) + passage + fresh(15) for _ in range(60)]
    near = fresh(40)
    lines += [near, [*near[:7], "other", *near[8:30], *near[31:]]]
    chosen = spark.createDataFrame([(i, len(w), " ".join(w)) for i, w in enumerate(lines)], "ord long, n int, plain string")
    keys = line_dedup._rare_keys(chosen, 10).collect()
    ords = {r.ord for r in keys}
    assert {60, 61} <= ords and len(ords) < 12  # by chance some lines are cut into few parts
    assert {r.key for r in keys if r.ord == 60} & {r.key for r in keys if r.ord == 61}


def test_line_dedup_tells_words_by_any_spaces(spark):
    base = " ".join(f"word{i}" for i in range(24))
    docs = [(1, base), (2, " " + base.replace(" ", "\t \x0b") + "\r"), (3, "\x0c\n \n" + base.replace("word3 ", "").replace("word9", "x") + " ")]
    got = {r.doc_id: (r.n_lines, r.n_equal, r.n_alike, r.text) for r in line_dedup.dedup(documents(spark, docs), words_per_edit=10).collect()}
    assert got == {1: (1, 0, 0, base), 2: (1, 1, 0, ""), 3: (1, 0, 1, "\x0c\n ")}


def test_line_dedup_awkward_and_empty(spark):
    rows = line_dedup.dedup(documents(spark, awkward())).collect()
    assert len(rows) == len(awkward())
    assert [r.text for r in rows if r.doc_id == 7] == [""]  # both lines stand in document 1
    assert {r.text for r in rows if r.doc_id == 1} == {awkward()[0][1]}  # repeated rows are one document
    assert line_dedup.dedup(documents(spark, awkward()).limit(0)).count() == 0


def test_exact_dedup(spark):
    rows = exact_dedup.decide(documents(spark, awkward())).collect()
    assert len(rows) == len(awkward())
    blank = [r for r in rows if r.doc_id in (2, 3, 4) or (r.doc_id is None and r.group_size == 4)]
    assert len(blank) == 4 and {r.keep_id for r in blank} == {4} and [r.doc_id for r in blank if r.kept] == [4]
    same = [r for r in rows if r.doc_id in (1, 7)]
    assert {r.group_size for r in same} == {3} and [r.doc_id for r in same if r.kept] == [7]  # more code points
    assert {r.text_sha256 for r in blank} == {hashlib.sha256(b"").hexdigest()}
    assert all(r.kept and r.group_size == 1 for r in rows if r.doc_id in (5, 6))
    assert exact_dedup.decide(documents(spark, awkward()).limit(0)).count() == 0


def test_exact_dedup_tie_and_filter(spark):
    docs = documents(spark, [(9, "a b"), (4, "ab "), (4, "ab "), (5, "a"), (None, "a")])
    rows = exact_dedup.decide(docs).collect()
    assert sum(r.kept for r in rows) == 2 and {r.keep_id for r in rows} == {4, 5}
    left = exact_dedup.keep_first(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 5]


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_jaccard_against_all_pairs(spark, k, percent):
    rng = random.Random(3)
    texts = [None, "", " \t", "one", "One", "one two"]
    for _ in range(50):
        base = [f"w{rng.randrange(200)}" for _ in range(rng.choice([1, 2, 4, 8, 12, 20, 40, 100, 300]))]
        texts += [" ".join(varied(base, rng.randrange(max(1, len(base) // 12) + 1), rng)) + rng.choice(["", "\n"]) for _ in range(rng.choice([1, 2, 5, 12]))]
    got = jaccard_join.link(documents(spark, list(enumerate(texts))), k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(list(range(len(texts))), texts, k, percent)


def test_jaccard_links_across_stars(spark, monkeypatch):
    """A chain of copies, each near only to its neighbours, compared in blocks of two."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 2)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(25):
        base = [*base[:i * 9], *[f"c{i}_{j}" for j in range(4)], *base[i * 9 + 4 :]]
        texts.append(" ".join(base))
    got = jaccard_join.link(documents(spark, list(enumerate(texts))), 4, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == components(list(range(25)), texts, 4, 85)


def test_jaccard_brings_no_text_to_pairs_that_sketches_tell_apart(spark, monkeypatch):
    """Texts that share a passage, so a cell, but are not near; two are near copies."""
    passage = " ".join(f"p{i}" for i in range(30))
    texts = [f"{passage} " + " ".join(f"d{j}w{i}" for i in range(30)) for j in range(40)]
    texts.append(texts[0] + " end")
    compared, verified = [], jaccard_join._verified

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verified(pairs, *more)

    monkeypatch.setattr(jaccard_join, "_verified", counted)
    got = {r.doc_id: r.component_id for r in jaccard_join.link(documents(spark, list(enumerate(texts))), 5, 80).collect()}
    assert got == {**{i: i for i in range(40)}, 40: 0}
    assert sum(compared) == 1


def test_jaccard_awkward_and_empty(spark):
    docs = documents(spark, awkward())
    rows = jaccard_join.link(docs).collect()
    assert len(rows) == len(awkward())
    assert all(r.n_shingles == 0 and r.component_id == r.doc_id for r in rows if r.doc_id in (2, 3, 4))
    assert {r.component_id for r in rows if r.doc_id in (1, 7)} == {1}
    left = jaccard_join.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 1, 2, 3, 4, 5, 6]
    assert jaccard_join.link(docs.limit(0)).count() == 0


def test_keep_one_with_repeated_and_null_ids(spark):
    """A row goes for its own text alone, and of near texts one stays whatever their ids."""
    near = [" ".join(f"a{i}" for i in range(60)) + f" end{j}" for j in range(2)]
    tied = [" ".join(f"b{i}" for i in range(60)) + f" end{j}" for j in range(2)]
    unnamed = [" ".join(f"c{i}" for i in range(60)) + f" end{j}" for j in range(2)]
    other = " ".join(f"d{i}" for i in range(60))
    rows = [(1, near[0]), (2, near[1]), (2, other), (3, tied[0]), (3, tied[1]), (None, unnamed[0]), (None, unnamed[1])]
    got = [(r.doc_id, r.text) for r in jaccard_join.keep_one(documents(spark, rows)).collect()]
    assert (1, near[0]) in got and (2, near[1]) not in got and (2, other) in got
    assert [i for i, t in got if t in tied] == [3]
    assert [i for i, t in got if t in unnamed] == [None]
    assert len(got) == 4
