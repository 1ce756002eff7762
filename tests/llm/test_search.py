import numpy as np
import pytest

from quern.llm import mtree


def rows_of(spark, vectors):
    return spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int")


def plain(vectors, every, k):
    own = {}
    for i, v, _ in vectors:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        own.setdefault(i, np.floor(64 * np.array(v, np.float32).astype(float)))
    out = []
    for i in own:
        if i % every == 0:
            found = sorted((-int(own[i] @ own[j]), j) for j in own if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "id", "score").collect())


def test_ties_nulls_and_repeated_rows(spark):
    random = np.random.default_rng(3)
    vectors = [(i, [float(x) for x in random.integers(-3, 4, 6) / 4], 0) for i in range(200)]
    vectors += [(i, [0.5] * 6, 1) for i in range(200, 260)]
    vectors += [(300, None, 0), (301, [0.5, None, 0.0, 0.0, 0.0, 0.0], 0), (302, [float("nan")] * 6, 0), (303, [float("inf")] * 6, 0)]
    vectors += [(None, [1.0] * 6, 0), (20, vectors[20][1], 0)]
    assert found(mtree.top_k(rows_of(spark, vectors), "id % 20 = 0", 7)) == plain(vectors, 20, 7)


def test_large_components(spark, monkeypatch):
    monkeypatch.setattr(mtree, "BLOCK", 50)
    monkeypatch.setattr(mtree, "LARGE_BLOCK", 3)
    random = np.random.default_rng(9)
    vectors = [(i, random.normal(size=4).tolist(), 0) for i in range(200)]
    for i, size in ((0, 3e4), (7, 2e4), (20, 5e6), (33, 6e6), (41, 1e7), (55, 1e7), (60, 2.0**24)):
        vectors[i] = (i, (size * random.normal(size=4)).tolist(), 0)
    vectors[80] = (80, [0.0, 1e30, 0.0, 0.0], 0)
    vectors[100] = (100, [float(1 << 20), 0.5], 0)

    def exact(v):
        return [int(np.floor(64 * float(np.float32(x)))) for x in v] + [0] * (4 - len(v))

    own = {i: exact(v) for i, v, _ in vectors}
    expected, limit = [], (1 << 63) - 1
    for i in range(0, 200, 20):
        best = sorted((-sum(a * b for a, b in zip(own[i], own[j], strict=True)), j) for j in own if j != i)[:7]
        expected += [(i, r + 1, j, max(-limit, min(limit, -s))) for r, (s, j) in enumerate(best)]
    assert found(mtree.top_k(rows_of(spark, vectors), "id % 20 = 0", 7)) == sorted(expected)
    alone = [v for v in vectors if v[0] in (20, 33, 41)]
    assert len(found(mtree.top_k(rows_of(spark, alone), "id % 20 = 0", 7))) == 2


def test_fewer_rows_than_asked_for(spark):
    vectors = [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0)]
    assert found(mtree.top_k(rows_of(spark, vectors), "id % 20 = 0", 20)) == plain(vectors, 20, 20)
    assert found(mtree.top_k(rows_of(spark, vectors).limit(0), "id % 20 = 0", 20)) == []


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_many_trees_and_pages(spark, monkeypatch, spread):
    monkeypatch.setattr(mtree, "TREE_POINTS", 300)
    monkeypatch.setattr(mtree, "LEAF", 20)
    random = np.random.default_rng(5)
    middle = random.normal(size=(6, 8))
    vectors = [(i, (middle[i % 6] + spread * random.normal(size=8)).tolist(), 0) for i in range(1500)]
    assert found(mtree.top_k(rows_of(spark, vectors), "id % 20 = 0", 10)) == plain(vectors, 20, 10)


def test_bounds_spare_distances():
    random = np.random.default_rng(1)
    points = np.round(np.repeat(random.normal(size=(40, 8)) * 60, 50, 0) + random.normal(size=(2000, 8)))
    space = mtree.Space(float((points * points).sum(1).max()))
    pages = {p["page"]: p for p in mtree.build(np.arange(2000), points, space)}
    search = mtree.Search(pages, space)
    search.top(np.array([0]), points[:1], 10, np.array([-np.inf]), np.array([0]))
    assert search.computed < 2000
