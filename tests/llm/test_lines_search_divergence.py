"""Shared lines, ranked search and source divergence against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from txlake.llm import divergence, lexical, line_dedup, near_duplicates, repeats, secret_scan

#: Column names that the operators use inside are data here.
SCHEMA = "doc_id long, text string, lang string, source string, row string, `n.docs` string, keep string, term string, item string"


def rows():
    r = random.Random(11)
    words = ["Thé", "of", "AND", "x1", "naïve", "日本", "É", "zu-zu", "it's"] + [f"w{chr(97 + i % 26)}{i}" for i in range(60)]
    shared = ["a line that is shared by MANY documents", "Été: une ligne partagée par beaucoup", "short one", "x" * 19, "x" * 20, "é" * 20]
    out = []
    for i in range(70):
        lines = [" ".join(r.choices(words, k=r.randint(1, 14))) for _ in range(r.randint(0, 5))]
        for s in r.sample(shared, r.randint(0, 4)):
            lines.insert(r.randint(0, len(lines)), r.choice(["", " \t", "\x0b"]) + (s if r.random() < 0.5 else s.replace("a", "A")) + r.choice(["", "  \r"]))
        out.append((i, "\n".join(lines), r.choice(["en", "en", "de", None]), r.choice(["s0", "s0", "s1", "", None])))
    out += [(100 + i, out[3][1], "en", "s0") for i in range(30)]  # copies
    out += [(200, None, "en", "s9"), (201, "", "fr", "s0"), (202, "\n\n", "fr", "s1"), (203, "solo", "xx", "s0"), (204, "12 34", "en", "lonely")]
    out += [(205, "\n".join(["the same line again and again"] * 50), "en", "s1"), (206, "the same line again and again", "en", "s0")]
    out += [(5, "the same line again and again\nother", "en", "s0"), (5, out[5][1], "en", "s0"), (None, shared[0], None, None), (None, "the same line again and again", "en", "s0")]
    out += [(300, "long " * 20_000 + "\n" + shared[0], "en", "s0")]
    return out


ROWS = rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([r + ("a", None, "b", "c", "d") for r in ROWS], SCHEMA).repartition(5)


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def kept_lines(rows):
    held = defaultdict(set)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    place = lambda i: -1 if i is None else i
    for i, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(place(i))
    return [[x for x in (t or "").split("\n") if len(held[key(x)]) < 3 or place(i) == max(held[key(x)])] for i, t, *_ in rows]


@pytest.mark.parametrize("small", [1000, 0])
def test_shared_lines(spark, docs, small, monkeypatch):
    monkeypatch.setattr(line_dedup, "SMALL", small)
    monkeypatch.setattr(line_dedup.keep_bitmaps, "__defaults__", (20, 3, small))
    want = [(i, len((t or "").split("\n")), len((t or "").split("\n")) - len(k), hashlib.sha256("\n".join(k).encode()).hexdigest()) for (i, t, *_), k in zip(ROWS, kept_lines(ROWS))]
    assert sum(w[2] for w in want) > 100
    assert sorted((tuple(r) for r in line_dedup.digests(docs).collect()), key=str) == sorted(want, key=str)
    full = line_dedup.without_shared_lines(docs)
    assert full.columns == docs.columns
    texts = sorted((r.doc_id, r.text) for r in full.where("doc_id <> 5").collect())
    assert texts == sorted((i, None if t is None else "\n".join(k)) for (i, t, *_), k in zip(ROWS, kept_lines(ROWS)) if i not in (None, 5))
    assert line_dedup.digests(docs.where("false")).count() == 0


def test_keep_bitmaps_are_runs(spark):
    line = "a line that three documents hold"
    made = spark.createDataFrame([(1, f"{line}\nown\nown too\n{line}\nend"), (2, f"x\n{line}"), (3, line)], "doc_id long, text string")
    got = {r.doc_id: (r.n_dropped, [tuple(x) for x in r.keep]) for r in line_dedup.keep_bitmaps(made).collect()}
    assert got == {1: (2, [(1, 2), (4, 1)]), 2: (1, [(0, 1)])}


def test_line_stream_shuffles_once(docs):
    plan = line_dedup.streamed(line_dedup.keyed_lines(docs), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("rangepartitioning") + plan.count("RoundRobin")
    assert "Python" not in plan and "Arrow" not in plan


SEARCHED = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LETTERS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(pattern, text):
    return [lower(w) for w in pattern.findall(text or "")]


def ranked(rows, items, k=20):
    bags = [Counter(terms(SEARCHED, t)) for _, t, *_ in rows]
    lengths = [sum(b.values()) for b in bags]
    n_docs, total = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for b in bags for t in b)
    out = []
    for item, text in set(items):
        asked, scores = Counter(terms(SEARCHED, text)), []
        for (i, *_), bag, n in zip(rows, bags, lengths):
            score = 0
            for t, times in asked.items():
                if t in bag:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * (75 + 25 * n * n_docs // total)))
            if score:
                scores.append((-score, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


ITEMS = [(1, "Thé of AND naïve wa0 wb1 wb1"), (2, ROWS[3][1]), (3, "日本 x1 É zu zu it"), (4, None), (5, "nowhere ever"), (None, "the same line again"), (3, "the same line again"), (1, "Thé of AND naïve wa0 wb1 wb1"), (7, "long again")]


@pytest.mark.parametrize("slice_bytes, beam, pack, descent", [(8 << 20, 8, 1 << 19, 1 << 13), (3000, 1, 6, 4), (300, 2, 1 << 19, 1)])
def test_ranked_documents(spark, docs, monkeypatch, slice_bytes, beam, pack, descent):
    monkeypatch.setattr(lexical, "SLICE", slice_bytes)
    monkeypatch.setattr(lexical, "BEAM", beam)
    monkeypatch.setattr(lexical, "DESCENT_TERMS", descent)
    items = spark.createDataFrame([i + ("x", 1) for i in ITEMS], "item_id long, text string, term string, rank long")
    got = lexical.search(docs, items, pack_terms=pack)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == ranked(ROWS, ITEMS)
    assert lexical.search(docs.where("false"), items).count() == 0
    assert lexical.search(docs, items.where("false")).count() == 0


def test_treap_holds_every_cell_once():
    r = np.random.default_rng(3)
    cells = np.unique(r.integers(0, [[700, 45]], (4000, 2)), axis=0)
    impact = r.integers(1, 9, len(cells))
    height, levels = lexical.treap(cells[:, 0], cells[:, 1], impact)
    grid = lexical.Grid(np.arange(45), np.arange(700, dtype=np.uint64), height, levels)
    assert sorted(zip(grid.row, grid.col, grid.impact)) == sorted(zip(*cells.T, impact))
    one = lexical.treap(np.array([0]), np.array([0]), np.array([5]))
    assert lexical.Grid(np.arange(1), np.arange(1, dtype=np.uint64), *one).impact.tolist() == [5]


def test_search_prunes(spark):
    """Ranges that cannot enter the best are not split: rare terms touch a small share of the grid."""
    r = np.random.default_rng(4)
    rows, cols = (x.ravel() for x in np.meshgrid(np.arange(64), np.arange(1024), indexing="ij"))
    impact = r.integers(1, 1000, len(rows))
    impact[(cols >= 500) & (cols < 520)] += 10_000
    grid = lexical.Grid(np.arange(1024), np.arange(64, dtype=np.uint64), *lexical.treap(rows, cols, impact))
    best, asked = lexical.Best(1, 20), np.arange(8)
    entered, real = [], best.add
    best.add = lambda item, score, doc: (entered.append(len(doc)), real(item, score, doc))
    lexical.descend(grid, best, np.zeros(8, np.int64), asked, np.ones(8, np.int64))
    total = impact.reshape(64, 1024)[:8].sum(0)
    assert best.doc[0].tolist() == sorted(range(1024), key=lambda d: (-total[d], d))[:20]
    assert sum(entered) < 200


def diverging(rows, ranks=200):
    docs = [(lang or "", source or "", Counter(terms(LETTERS, t))) for _, t, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = [t for t in df if df[t] >= 3]
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, bag in own:
            counts[s].update({t: bag[t] for t in bag if df[t] >= 3})
        everything = sum(counts.values(), Counter())

        def share(bag):
            total = sum(bag.values()) + len(kept)
            return {t: 1 + 10**9 * (bag[t] + 1) // total for t in kept}

        shares, q_all = {s: share(bag) for s, bag in counts.items()}, share(everything)
        f = lambda p, q: (p - q) ** 2 // q
        for s, p in shares.items():
            pairs = [(sum(f(p[t], q[t]) for t in kept), o) for o, q in shares.items() if o != s]
            used = [(f(p[t], q_all[t]), t) for t in kept if counts[s][t] and p[t] > q_all[t]]
            for part, found, most in (("pair", pairs, None), ("term", used, ranks)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, r + 1) for r, (value, item) in enumerate(found[:most])]
    return sorted(out)


@pytest.mark.parametrize("bits, ranks", [(12, 200), (2, 200), (0, 3)])
def test_divergences(spark, docs, bits, ranks):
    got = divergence.divergences(docs, bits=bits, most_ranks=ranks)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == diverging(ROWS, ranks)


def test_divergences_of_nothing(docs):
    assert divergence.divergences(docs.where("false")).count() == 0


def test_equal_subtrees_are_one_node_and_pairs_are_priced_once():
    counts = np.zeros((3, 64), np.int64)
    counts[1, 5], counts[2, 5], counts[2, 40] = 7, 7, 1
    roots, levels, leaves = divergence.consed(counts)
    assert len(set(roots.tolist())) == 3 and leaves.tolist() == [0, 1, 7]
    assert sum(len(a) for a, _ in levels) <= 3 + 3 * 5
    pair, a, b, times = divergence.walked(roots, levels, np.array([0, 1]), np.array([1, 2]))
    found = {(int(p), int(leaves[x]), int(leaves[y])): int(t) for p, x, y, t in zip(pair, a, b, times)}
    assert found == {(0, 0, 0): 63, (0, 0, 7): 1, (1, 0, 0): 62, (1, 7, 7): 1, (1, 0, 1): 1}


def test_shares_are_exact(spark):
    values = [(0, 1), (10**15 - 1, 10**15), (3_333_333_333_333, 9_999_999_999_999), (5, 7)]
    column = divergence.share_column(F.col("a"), F.col("b"))
    got = [r[0] for r in spark.createDataFrame(values, "a long, b long").select(column).collect()]
    want = [1 + 10**9 * (a + 1) // b for a, b in values]
    assert got == want
    assert [1 + int(divergence.divided(np.int64(a + 1), np.int64(b), np.divmod)) for a, b in values] == want


def test_survivors_are_chosen_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near = a.replace("a39", "changed")
    rows = [(1, a), (1, b), (2, a), (None, c), (None, c), (None, d), (3, near), (4, b), (7, ""), (7, ""), (None, None), (9, d), (9, d)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, `a.b` int").repartition(3)
    got = near_duplicates.survivors(docs)
    assert got.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (None, c), (9, d), (7, ""), (7, ""), (None, None)], key=str)
    assert near_duplicates.survivors(docs.where("false")).count() == 0


def test_names_with_dots(spark):
    words = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, words, "x"), (2, "own\n" + words + " tail", "y"), (3, words, "z")], "doc_id long, text string, `a.b` string")
    got = repeats.without_repeats(docs)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, words, "x"), (2, "own tail", "y")]
    assert secret_scan.redacted(docs).columns == docs.columns
