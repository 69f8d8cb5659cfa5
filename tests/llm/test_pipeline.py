"""The pipeline against its stages by plain code."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from rowgate.llm import toxicity as tox
from tests.llm.helpers import SF, docs, odd_rows, plain_classes, plain_dedup, with_clashes, words


def test_stages(spark):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    clean = corpus_pipeline.toxicity(spark, d, SF)
    scores = {r.doc_id: r.score for r in tox.op4_toxicity_mil(spark, SF).collect()}
    rows = {r.doc_id: r for r in clean.collect()}
    assert clean.columns == d.columns and set(rows) == {i for i, s in scores.items() if s < tox.THRESHOLD}
    once = corpus_pipeline.near_duplicates(spark, clean, SF)
    classes = plain_classes([(i, r.text) for i, r in rows.items()])
    kept = {r.doc_id: r for r in once.collect()}
    assert once.columns == d.columns and set(kept) == {i for i, r in rows.items() if r.text not in classes or classes[r.text][0] == i}
    cut = corpus_pipeline.repeated_passages(spark, once, SF)
    left = {r.doc_id: r for r in cut.collect()}
    want = {i: k for i, n, _, k in plain_dedup([(i, r.text) for i, r in kept.items()]) if k or not n}
    assert cut.columns == d.columns and {i: words(r.text) for i, r in left.items()} == want
    mix = corpus_pipeline.mixing(spark, cut, SF)
    assert mix.columns == d.columns
    n = sum(len(words(r.text)) for r in mix.collect())
    assert n == pytest.approx(1.5 * sum(map(len, want.values())), rel=0.05)
    assert corpus_pipeline.tokens(spark, mix, SF).count() == mix.count()


def test_run_and_registration(spark):
    assert entry.queries()["pipeline"] is corpus_pipeline.run
    ops = sorted(int(k[2:].split("_")[0]) for k in entry.queries() if k.startswith("op"))
    assert ops == list(range(1, 14))
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 0


def test_odd_and_empty_tables(spark):
    for rows in (odd_rows(), []):
        d = with_clashes(docs(spark, rows))
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, d, SF)
            assert got.columns == d.columns or name == "tokens"
            got = got.collect()
            assert len(got) > 0 if rows else len(got) == 0
            assert name == "tokens" or all(r["a.b"] == r["c`d"] == "clash" for r in got)
