"""Top-k search against brute force."""

import math

import numpy as np
import pytest

from headway.llm import mtree


def brute(rows, k, every):
    ok = {(i, tuple(math.floor(64 * float(c)) for c in v)) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for q, x in {(i, x) for i, x in ok if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in ok if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(spark, rows, k, every):
    df = spark.createDataFrame([(i, v, "extra", 0) for i, v in rows], "vec_id long, embedding array<float>, x string, uid int")
    return sorted(tuple(r) for r in mtree.top_k(df, k, every).select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("spread", [0.01, 0.5])
def test_against_brute_force(spark, monkeypatch, spread):
    for name, value in (("BLOCK", 64), ("PAGE", 6), ("BATCH", 16)):
        monkeypatch.setattr(mtree, name, value)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 6))
    points = (centres[rng.integers(0, 5, 500)] + spread * rng.normal(size=(500, 6))).astype(np.float32)
    points[100:260] = points[7]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    assert found(spark, rows, 5, 7) == brute(rows, 5, 7)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [-0.01, 0.0]), (7, [1.0]), (8, [])]
    assert found(spark, rows, 3, 2) == brute(rows, 3, 2)
    assert found(spark, [], 3, 2) == []
    assert found(spark, [(0, [1.0])], 3, 1) == []


def test_many_lengths(spark, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK", 8)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=1 + i % 70).round(2).tolist()) for i in range(140)] + [(200 + i, rng.normal(size=3).round(2).tolist()) for i in range(60)]
    assert found(spark, rows, 4, 3) == brute(rows, 4, 3)


def test_queries_are_sent_only_where_better_ones_may_lie(spark, monkeypatch):
    for name, value in (("BLOCK", 64), ("PAGE", 8)):
        monkeypatch.setattr(mtree, name, value)
    sent, save = {}, mtree.save

    def count(df, name):
        out = save(df, name)
        if name in ("planted", "routed"):
            sent[name] = out.count() if name == "routed" else out.filter("tree IS NOT NULL").count() * out.filter("asked IS NOT NULL").count()
        return out

    monkeypatch.setattr(mtree, "save", count)
    rng = np.random.default_rng(9)
    points = np.repeat(np.eye(8) * 20, 100, 0) + rng.normal(size=(800, 8)) * 0.1
    rows = [(i, p.tolist()) for i, p in enumerate(points.astype(np.float32))]
    assert found(spark, rows, 3, 10) == brute(rows, 3, 10)
    # a batch of queries needs the blocks of its own cluster
    assert 0 < sent["routed"] < sent["planted"] / 2


def test_bounds_spare_computations():
    rng = np.random.default_rng(1)
    x = (np.repeat(np.eye(8) * 1000, 200, 0) + rng.integers(0, 9, (1600, 8))).astype(np.int64)
    top = float((x * x).sum(1).max())
    tree = mtree.build(np.arange(1600), x, top)
    search, pairs = mtree.Search(np.arange(4), x[:4], 5, top), []
    put = search.put
    search.put = lambda rows, score, uid: (pairs.append(score.size), put(rows, score, uid))
    search.tree(tree)
    want = np.sort(x[:4] @ x.T, 1)[:, ::-1][:, :5]
    assert (search.score == want).all() and sum(pairs) < 4 * 1600 / 2


@pytest.mark.parametrize("case", ["outlier", "large"])
def test_magnitudes(spark, case):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 64)).astype(np.float32)
    if case == "large":
        x *= np.float32(4e5)
    else:
        x[10, 3] = 3e11
        x[11] = 0
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert found(spark, rows, 5, 5) == brute(rows, 5, 5)


def test_scores_over_64_bits(spark):
    assert mtree.products(np.array([[2**40, 1], [2**31, 0]]), np.array([[2**40, 0], [-(2**40), 5]])).tolist() == [[mtree.LARGEST, -mtree.LARGEST], [mtree.LARGEST, -mtree.LARGEST]]
    with pytest.raises(Exception, match="64 bits"):
        found(spark, [(0, [3e11, 0.0]), (1, [3e11, 1.0])], 1, 2)
