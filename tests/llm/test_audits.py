from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from surfrank.llm import divergence, filter_audit
from surfrank.llm.queries import QUERIES
from tests.llm.helpers import WORD, awkward, documents

SF = "/root/testdata/sf0.001"
NAMES = "ABCDE"


def fails(rows):
    """The filters that each (doc_id, text, ...) row fails."""
    first: dict = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    out = []
    for doc_id, text, *_ in rows:
        text = text or ""
        words = WORD.findall(text)
        told = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > first[text],
        }
        out.append({k for k, v in told.items() if v})
    return out


def audit_brute(rows, good, toxic):
    """Every order applied step by step to lists of rows."""
    parts = defaultdict(list)
    for row, failed in zip(rows, fails(rows), strict=True):
        parts[row[3] or ""].append((row[0], failed))
    out, shapley = [], Counter()
    for part, members in parts.items():
        for order in map("".join, permutations(NAMES)):
            left = members
            for step, k in enumerate(order, 1):
                gone = [m for m in left if k in m[1]]
                left = [m for m in left if k not in m[1]]
                shapley[part, k] += len(gone)
                out.append(
                    (part, order, step, len(left), len(gone), sum(k in m[1] for m in members) - len(gone), sum(m[1] == {k} for m in members),
                     sum(m[0] in good for m in gone), sum(m[0] in toxic for m in gone))
                )
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def audited(docs, labels):
    losses = {k: filter_audit.label_ids(labels, c) for k, c in (("good_lost", "quality = 1"), ("toxic_lost", "toxic = 1"))}
    got = filter_audit.audit(docs, filter_audit.text_filters(F.col("text")), losses, repeats="E")
    return sorted(tuple(r[c] for c in COLUMNS) for r in got.collect())


def test_filter_audit_against_every_order_by_hand(spark):
    rng = random.Random(4)
    rows = [(r[0], r[1], "en", rng.choice(["s0", None])) for r in awkward()]
    for i in range(10, 90):
        words = [rng.choice(["alpha", "Beta", "GAMMA", f"w{rng.randrange(80)}", "x#y", "é"]) for _ in range(rng.choice([3, 49, 50, 90]))]
        rows.append((i, " ".join(words), "en", rng.choice(["s0", "s1", "", None])))
        if rng.random() < 0.4:
            rows.append((rng.randrange(120), rows[-1][1], "en", rng.choice(["s0", "s1"])))
    labels = spark.createDataFrame(
        [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(100)] + [(1, 1, 1), (1, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int"
    )
    marks = labels.collect()
    good = {r.doc_id for r in marks if r.quality == 1 and r.doc_id is not None}
    toxic = {r.doc_id for r in marks if r.toxic == 1 and r.doc_id is not None}
    got = audited(documents(spark, rows), labels)
    assert got == audit_brute(rows, good, toxic)
    assert len(got) == 600 * len({r[3] or "" for r in rows})
    assert audited(documents(spark, rows).filter(F.lit(False)), labels) == []


def test_filter_audit_takes_any_filters(spark):
    docs = documents(spark, [(1, "a b"), (2, "a"), (3, None)])
    got = filter_audit.audit(docs, {"S": F.length("text") < 2, "Z": F.col("text") == "a"}, {}, None)
    assert sorted(tuple(r) for r in got.drop("unique_fails", "shapley").collect()) == [
        ("s0", "SZ", 1, 1, 2, 0), ("s0", "SZ", 2, 1, 0, 1), ("s0", "ZS", 1, 2, 1, 0), ("s0", "ZS", 2, 1, 1, 1),
    ]


def divergence_brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), Counter(), set()
    for _, text, lang, source in rows:
        group = (lang or "", source or "")
        groups.add(group)
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[group].update(terms)
        docs.update((group[0], t) for t in set(terms))
    kept = defaultdict(list)
    for (lang, term), n in docs.items():
        if n >= min_docs:
            kept[lang].append(term)
    share = {}
    for lang, source in groups:
        total = sum(counts[lang, source][t] for t in kept[lang])
        share[lang, source] = {t: 1 + 10**9 * (counts[lang, source][t] + 5) // (total + 5 * len(kept[lang])) for t in kept[lang]}
    out = []
    for lang, source in groups:
        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update({t: counts[g][t] for t in kept[lang]})
        total = sum(whole.values())
        p = share[lang, source]
        pairs = [(sum(abs(p[t] - share[g][t]) for t in kept[lang]), g[1]) for g in groups if g[0] == lang and g[1] != source]
        terms = [(p[t] - 1 - 10**9 * (whole[t] + 5) // (total + 5 * len(kept[lang])), t) for t in kept[lang] if counts[lang, source][t]]
        terms = [x for x in terms if x[0] > 0]
        for part, items, most in (("pair", pairs, None), ("term", terms, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(items[:most], 1)]
    return sorted(out)


def diverged(docs, **options):
    got = divergence.audit(docs, **options)
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in got.collect())


def _varied():
    rng = random.Random(11)
    words = [f"{a}{b}" for a in "abcdefghijé" for b in ("x", "Y", "ß", "日本", "\U0001f600")]
    rows = [(*r, rng.choice(["en", None]), rng.choice(["s0", "s1", None])) for r in awkward()]
    for i in range(150):
        some = rng.sample(words, rng.choice([1, 5, 20]))
        rows.append((i, rng.choice([" ", "1", "\n", "[`"]).join(rng.choices(some, k=rng.choice([0, 3, 40]))), rng.choice(["en", "de", "fr", ""]), f"s{rng.randrange(5)}"))
    return [*rows, (900, "zz " * 9, "la", "only"), (901, "zz", "xx", "s0"), (902, None, "xx", "s1")]


@pytest.mark.parametrize(("block", "tile"), [(8192, 128), (4, 2)])
def test_divergence_against_brute_force(spark, monkeypatch, block, tile):
    """Also with columns cut into many blocks and tiles."""
    monkeypatch.setattr(divergence, "BLOCK", block)
    monkeypatch.setattr(divergence, "TILE", tile)
    rows = _varied()
    assert diverged(documents(spark, rows), min_docs=3, top=4) == divergence_brute(rows, 3, 4)


def test_long_texts_are_split_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = b"  one  seventeen-letters a b c    " + b"x" * 50 + b" end"
    pieces = list(divergence._words(text))
    assert [w for p in pieces for w in p] == text.split() and len(pieces) > 4


def test_divergence_of_an_empty_table(spark):
    assert diverged(documents(spark, [(1, "x")]).filter(F.lit(False))) == []


def test_run_length_columns_cluster_equal_counts(spark):
    """Terms that every source has equally often are one run, however many they are."""
    rows = [(i, " ".join(f"t{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)), "en", f"s{i % 2}") for i in range(40)]
    docs = documents(spark, rows)
    counts = divergence.term_counts(docs)
    vocab = divergence.vocabulary(counts, 30)
    cells = counts.filter("term is not null").select("lang", "source", "term", "n").join(vocab, ["lang", "term"])
    groups = spark.createDataFrame([("en", f"s{i}", 6000, 300, 1, 0) for i in (0, 1)], "lang string, source string, total long, kept long, tiles int, tile int")
    columns = divergence.columns(cells, groups, vocab).collect()
    assert sum(c.places for c in columns) == 600 and all(len(c.runs) == 1 for c in columns)


def test_queries_read_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_filter_audit"](spark, SF).collect())
    assert got == audit_brute(docs, {r.doc_id for r in labels if r.quality == 1}, {r.doc_id for r in labels if r.toxic == 1})
    found = sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in QUERIES["op13_source_divergence"](spark, SF).collect())
    assert found == divergence_brute(docs, 30, 50)
