"""The corpus pipeline against its stages in brute force, and the registration of the package's queries."""

from __future__ import annotations

import corpus_pipeline
import pytest
import __spark_entry__ as entry
from txlake.llm import quality, queries

from .test_operators import TEXTS, WORD, base_spans, shingles, windows_gone


def test_stages(spark, tmp_path):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in TEXTS if i is not None]
    rows = list({r[0]: r for r in rows}.values())
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")

    # One label certifies no cutoff, so the base rule alone decides.
    left = []
    for i, t, *_ in sorted(rows):
        w = WORD.findall(t or "")
        found = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        repeated = {k for j, f in enumerate(found) if found.count(f) > 1 for k in (j, j + 1, j + 2)} if len(w) < 2000 else set(range(len(w)))
        if len(w) >= quality.MIN_WORDS and 2 * len(repeated) <= len(w):
            left.append((i, t))
    kept, sets = [], {i: shingles(t, 5) for i, t in left}
    label = {i: i for i, _ in left}
    for _ in left:
        for i in label:
            for j in label:
                common = len(sets[i] & sets[j])
                if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    label[i] = min(label[i], label[j])
    kept = [(i, t) for i, t in left if label[i] == i]
    words = [WORD.findall(t) for _, t in kept]
    gone = windows_gone(words, [i for i, _ in kept])
    want = {i: [x for x, y in zip(w, g) if not y] for (i, _), w, g in zip(kept, words, gone) if not all(g)}

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        counts.append(docs.count())
    assert counts[:2] == [len(left), len(kept)]
    got = {r.doc_id: r for r in docs.collect()}
    assert {i: WORD.findall(r.text) for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) and not base_spans(r.text) for r in got.values())
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == set(want)


def test_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(queries.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_equals_its_sql(spark, duck, name):
    found = duck.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, "/root/testdata/sf0.001")
    assert sorted(got.columns) == sorted(found.columns)
    assert sorted(tuple(r) for r in got.select(*found.columns).collect()) == sorted(found.fetchall())
