"""Hard negatives, embedding near-dedup and the filter audit against plain versions."""

from __future__ import annotations

import math
import re
from itertools import permutations

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rowgate.llm import filter_audit, itq, kronecker
from tests.llm.helpers import SF, docs, odd_rows, with_clashes, words

NAN, INF = float("nan"), float("inf")
EXTRA = ["block", "anchor", "wanted", "score", "id", "code", "ball", "court", "key", "n", "node", "a.b"]


def vectors(spark, rows, clashes=True):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    return df.select("*", *[F.lit("clash").alias(c) for c in EXTRA]) if clashes else df


# 11 hard negatives

def plain_negatives(rows, anchors, k=5, floor=80):
    """By looking at every pair; ``rows``: id -> (label, components)."""
    x = {i: (label, [math.floor(256 * c) if abs(c) < 1 << 52 else 256 * int(c) for c in v]) for i, (label, v) in rows.items()}
    out = set()
    for a in anchors:
        score = {i: sum(p * q for p, q in zip(x[a][1], v)) for i, (_, v) in x.items() if i != a}
        best = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in best if x[i][0] == x[a][0]][:k]:
            fit = [i for i in best if x[i][0] != x[a][0] and floor * score[p] <= 100 * score[i] <= 100 * score[p]]
            out |= {(a, p, n, i, score[p], score[i]) for n, i in enumerate(fit[:k], 1)}
    return out


@pytest.mark.parametrize("block,chunk", [(1 << 16, 1 << 16), (40, 2)])
def test_negatives_against_all_pairs(spark, block, chunk):
    r = np.random.RandomState(1)
    centres = r.normal(size=(6, 8))
    data = {i: (int(i % 3), (np.round(centres[i % 6] + 0.4 * r.normal(size=8), 1 if i % 2 else 5)).astype(np.float32).tolist()) for i in range(-20, 230)}
    rows = [(i, v, label) for i, (label, v) in data.items()]
    odd = [(300, None, 1), (400, [NAN] * 8, 1), (500, [INF] + [0.0] * 7, 2), (600, [None] * 8, 0), (700, [1.0] * 8, None), (None, [1.0] * 8, 1),
           (800, [1.0, 2.0], 1), (900, [], 1)]
    table = vectors(spark, rows + odd + rows[:9] + [(7, [9.0] * 8, 2)])  # repeated rows; an id with two labels
    got = [tuple(x) for x in kronecker.mine(table, F.col("vec_id") % 100 == 0, block=block, chunk=chunk).collect()]
    want = plain_negatives(data, [0, 100, 200])
    assert len(got) == len(set(got)) and {(a, p, n, i, s, t) for a, p, n, i, s, t in got} == want
    assert len({a for a, *_ in want}) >= 2


def test_negatives_of_small_tables(spark):
    assert kronecker.mine(vectors(spark, []), F.col("vec_id") % 100 == 0).count() == 0
    # no other row of the label; no negative within the bounds; a negative score admits none
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.0], 2), (100, [0.0, 1.0], 3), (101, [0.0, 1.0], 3), (102, [0.0, -1.0], 4),
            (200, [-1.0, 0.0], 5), (201, [1.0, 0.0], 5)]
    assert kronecker.mine(vectors(spark, rows), F.col("vec_id") % 100 == 0).count() == 0
    ties = [(0, [1.0, 1.0], 1), (9, [1.0, 1.0], 1)] + [(i, [0.9, 1.0], 2) for i in (30, 8, 5, 44, 3, 61, 7)]
    got = sorted(map(tuple, kronecker.mine(vectors(spark, ties), F.col("vec_id") % 100 == 0).collect()))
    assert [g[:4] for g in got] == [(0, 9, n, i) for n, i in enumerate([3, 5, 7, 8, 30], 1)]


@pytest.mark.parametrize("scale", [1e-3, 1.0, 1e3, 1e9, 1e20])
def test_packed_products_are_exact(scale):
    r = np.random.RandomState(3)
    x = kronecker.integers(r.normal(size=(37, 5)) * scale)
    a = kronecker.integers(r.normal(size=(4, 5)) * scale)
    bias = -int(a.min())
    packs = kronecker.packed_block(x, int(a.max()) + bias)
    for one in a:
        want = [sum(int(p) * int(q) for p, q in zip(one.tolist(), v)) for v in x.tolist()]
        assert [int(s) for s in kronecker.all_scores(packs, one, bias).tolist()] == want


def test_components_become_whole_numbers_downwards():
    assert kronecker.integers(np.array([[0.1, -0.1, -1.0, 0.0]])).tolist() == [[25, -26, -256, 0]]
    assert kronecker.integers(np.array([[1e30, -0.1]])).tolist() == [[256 * int(1e30), -26]]


# 12 near-dedup

def plain_links(x, threshold=0.95):
    u = x / np.sqrt((x * x).sum(1, keepdims=True))
    linked = u @ u.T >= threshold
    np.fill_diagonal(linked, False)
    label = np.arange(len(x))
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(x)).min(axis=1))
        if (new == label).all():
            return linked.sum(1), label
        label = new


def at_cosine(r, v, c):
    other = r.normal(size=v.shape)
    other -= (other @ v) / (v @ v) * v
    return c * v / np.linalg.norm(v) + math.sqrt(1 - c * c) * other / np.linalg.norm(other)


@pytest.fixture(scope="module")
def planted():
    """Pairs and chains at all cosines around the threshold, copies, and two groups
    of a hundred, one tight and one wide."""
    r = np.random.RandomState(7)
    x = list(r.normal(size=(400, 48)))
    for k, c in enumerate(np.linspace(0.94, 0.999, 120)):
        x.append(at_cosine(r, x[k], c) * (1 + k % 3))
    for _ in range(6):  # a chain
        x.append(at_cosine(r, x[-1], 0.955))
    x += [x[3], x[3], 2 * x[4]]
    x += [at_cosine(r, x[10], c) for c in r.uniform(0.99, 1, 150)]
    x += [at_cosine(r, x[11], c) for c in r.uniform(0.955, 0.99, 150)]
    return np.array(x).astype(np.float32).astype(float)


@pytest.mark.parametrize("dense", [4, 10_000])
def test_links_against_all_pairs(spark, planted, dense):
    ids = np.arange(len(planted)) * 3 + 1
    rows = [(int(i), v, 0) for i, v in zip(ids, planted.tolist())]
    got = {g.vec_id: g for g in itq.near_duplicates(vectors(spark, rows), dense=dense).collect()}
    n_links, label = plain_links(planted)
    assert len(got) == len(ids)
    found = sum(got[i].n_links for i in ids.tolist())
    assert found <= n_links.sum() and found >= 0.995 * n_links.sum()
    assert all(got[i].n_links <= n for i, n in zip(ids.tolist(), n_links.tolist()))
    same = np.mean([got[i].component_id == ids[c] for i, c in zip(ids.tolist(), label.tolist())])
    assert same >= 0.98 and all(g.kept == (g.vec_id == g.component_id) for g in got.values())


def test_large_groups_are_balls(planted):
    coder = itq.Coder(planted)
    ball = coder.ball_of(planted)
    u = itq.unit(planted)
    assert (ball >= 0).sum() >= 150
    for b in set(ball.tolist()) - {-1}:
        assert (u[ball == b] @ u[ball == b].T >= 0.95).all()
    bits = np.array([[int(c) >> k & 1 for k in range(48)] for c in coder.codes(planted[:400]).tolist()])
    assert 0.35 < bits.mean() < 0.65


def test_near_duplicates_odd(spark):
    rows = [(0, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [2.0, 0.0], None), (4, [0.0, 1.0], 1), (5, None, 1), (6, [0.0, 0.0], 1), (7, [NAN, 1.0], 1),
            (8, [INF, 1.0], 1), (9, [None, 1.0], 1), (None, [1.0, 0.0], 1), (None, None, None), (10, [1.0, 0.0, 0.0], 1), (4, [0.0, 1.0], 1), (11, [], 1)]
    got = sorted(map(tuple, itq.near_duplicates(vectors(spark, rows)).collect()), key=str)
    own = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted([(0, 2, 0, True), (2, 2, 0, False), (3, 2, 0, False), *own, (None, 0, None, True), (None, 0, None, True)], key=str)
    assert itq.near_duplicates(vectors(spark, [])).count() == 0
    assert [tuple(g) for g in itq.near_duplicates(vectors(spark, [(1, None, 1)])).collect()] == [(1, 0, 1, True)]


def test_op12_on_the_given_table(spark):
    x = np.array(pq.read_table(f"{SF}/embeddings.parquet")["embedding"].to_pylist(), float)
    assert sum(g.n_links for g in itq.op12_itq_dedup(spark, SF).collect()) == plain_links(x)[0].sum()


# 13 filter audit

def plain_audit(rows, labels):
    """``rows``: (doc_id, text, source)."""
    good = {i for i, q, _ in labels if q == 1} - {None}
    toxic = {i for i, _, t in labels if t == 1} - {None}
    first: dict = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    per: dict = {}
    for i, t, s in rows:
        t = t or ""
        w = words(t)
        fails = {f for f, hit in (("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)), ("C", 100 * len(re.findall("[A-Z]", t)) > 2 * len(t)),
                                  ("D", re.search(r"[#$%&*|]", t)), ("E", i is not None and i > first[t])) if hit}
        per.setdefault(s or "", []).append((fails, i in good, i in toxic))
    out, shapley = {}, {}
    for part, documents in per.items():
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                c = [0] * 6
                for fails, g, x in documents:
                    before = bool(fails & set(order[:k]))
                    hit = f in fails and not before
                    c = [a + b for a, b in zip(c, (not before and not hit, hit, f in fails and before, fails == {f}, hit and g, hit and x))]
                out[part, "".join(order), k + 1] = c
                shapley[part, f] = shapley.get((part, f), 0) + c[1]
    return {(p, o, k, *c, shapley[p, o[k - 1]]) for (p, o, k), c in out.items()}


def test_filter_audit(spark):
    rows = odd_rows()
    long = " ".join(f"w{k}" for k in range(260))
    rows += [(100 + i, long if i % 2 else f"{long} # A", "en", "s1" if i % 3 else "", 0) for i in range(9)]
    rows += [(None, long, "en", None, 0)] * 3 + [(101, long, "en", "s1", 0)]
    label_rows = [(i, i % 2, (i + 1) % 2) for i in range(0, 108) if i % 4 != 3] + [(101, 1, 0), (101, 0, None), (None, 1, 1), (9999, 1, 1)]
    labels = with_clashes(spark.createDataFrame(label_rows, "doc_id long, quality int, toxic int"))
    table = with_clashes(docs(spark, rows)).withColumn("a.b", F.lit(1)).withColumn("part", F.lit("x")).withColumn("mask", F.lit(1))
    got = [tuple(r) for r in filter_audit.audit(filter_audit.cells(table, labels)).collect()]
    want = plain_audit([(i, t, s) for i, t, _, s, _ in rows], label_rows)
    assert len(got) == len(want) == 600 * 4 and set(got) == want
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.cells(docs(spark, []), labels)).count() == 0
    assert filter_audit.audit(filter_audit.cells(docs(spark, rows[:1]), none)).count() == 600


def test_copies_meet_folded(spark):
    """What meets under one digest is one row for each part and label, whatever the number of copies."""
    rows = [(i, "the very same text", "en", f"s{i % 2}", 0) for i in range(500)]
    got = filter_audit.cells(docs(spark, rows), spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int")).collect()
    by = {(r.part, r.mask, r.good): r.n for r in got}
    assert by == {("s0", 1, 0): 1, ("s0", 17, 0): 249, ("s1", 17, 0): 249, ("s1", 17, 1): 1}
