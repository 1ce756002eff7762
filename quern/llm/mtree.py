"""Exact top-k search by inner product in M-trees, best first.

Vectors become points: an extra coordinate lifts each to the same length, so that a query's distance to a point falls as
their inner product rises. Points are dealt to regions by the nearest of a bounded number of pivots, and each region
(large ones in several parts) is one tree of pages. A page holds its entries' vectors, their distances to the page's
routing point and, above the leaves, covering radii and the smallest id below. A search opens the page with the best
bound first. An entry whose stored distances prove, by the triangle inequality, that it lies too far is passed over
without its own distance being computed.

Queries first search the tree they lie in. What they find there bounds the other trees: only those whose root can still
hold a better point are searched. Scores are integers and exact; distances only prune, with a margin for rounding.

Trees are limited in number (``TREES``), so their roots are a bounded broadcast; a task holds one tree and a bounded
number of queries (``QUERIES``).

Vectors with a component too large for exact products in doubles (``LARGEST``) are in no tree. They are joined with all
rows, block by block, and their scores are computed in whole numbers.

Defined results: rows with a null id, a null vector, or a component that is null or not finite take no part. A score
beyond a long is given as the nearest long, and such scores are ordered by their values as doubles. Shorter vectors are filled up with zeros. Rows that repeat an id count once (the smallest vector).
Of equal scores the smaller id is first. Queries with fewer other rows return all. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.shared import Stage

#: Points of a tree while there are fewer than TREES of them; pages; entries above the leaves and in them.
TREE_POINTS, TREES = 4_096, 4_096
FANOUT, LEAF = 16, 256
#: Queries that search a tree in one task.
QUERIES = 4_096
#: Vectors with components beyond this are in no tree, so that inner products there are exact in doubles.
LARGEST = 1 << 20
#: Rows of a block, and of vectors too large for trees, that are joined in one task.
BLOCK, LARGE_BLOCK = 4_096, 4_096
LONGEST = (1 << 63) - 1

PAGES = "tree int, page int, leaf boolean, ids array<long>, vectors binary, radii array<double>, to_parent array<double>, children array<int>"
FOUND = "query_id long, id long, score long"
FOUND_LARGE = FOUND + ", size double"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 64.0) -> DataFrame:
    """(id, v array<int>, large array<double>): floor(scale * x) of each component, in ``large`` if one is beyond LARGEST."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, large = [], [], []
            for own, vector in zip(*batch.columns, strict=True):
                if not own.is_valid or not vector.is_valid or vector.values.null_count:
                    continue
                x = np.floor(scale * vector.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.all(np.isfinite(x)):
                    fits = np.all(np.abs(x) <= LARGEST)
                    ids.append(own.as_py())
                    rows.append(x.astype(np.int32) if fits else None)
                    large.append(None if fits else x)
            columns = [pa.array(ids, pa.int64()), pa.array(rows, pa.list_(pa.int32())), pa.array(large, pa.list_(pa.float64()))]
            yield pa.record_batch(columns, ["id", "v", "large"])

    chosen = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    rows = chosen.mapInArrow(run, "id long, v array<int>, large array<double>")
    rows = rows.groupBy("id").agg(F.min("v").alias("v"), F.min("large").alias("large"))
    fits = F.expr("large IS NULL OR (v IS NOT NULL AND CAST(v AS array<double>) < large)")
    return rows.select("id", F.when(fits, F.col("v")).alias("v"), F.when(~fits, F.col("large")).alias("large"))


def _matrix(column, width: int) -> np.ndarray:
    """Vectors as rows of doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


@dataclass
class Space:
    """The points that vectors are lifted to: ``square`` is the common squared length."""

    square: float

    def lift(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0.0, self.square - (x * x).sum(-1)))

    def apart(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances of points x (one or many) to y (one)."""
        return np.sqrt(np.maximum(0.0, 2 * (self.square - x @ y - self.lift(x) * self.lift(y))))

    def margin(self) -> float:
        return 1e-6 * (1 + self.square**0.5)


def build(ids: np.ndarray, points: np.ndarray, space: Space, seed: int = 7) -> list[dict]:
    """Pages of one tree, the root first.

    Each page's points are dealt to the nearest of up to FANOUT of them; points that can't be told apart are dealt
    in equal parts.
    """
    random, pages = np.random.default_rng(seed), []

    def page(own: np.ndarray, routing: np.ndarray | None) -> int:
        number = len(pages)
        made = {"page": number, "leaf": len(own) <= LEAF}
        pages.append(made)
        if made["leaf"]:
            away = np.zeros(len(own)) if routing is None else space.apart(points[own], routing)
            order = np.lexsort([ids[own], away])
            own = own[order]
            made |= {"ids": ids[own], "vectors": points[own], "radii": np.zeros(len(own)), "children": np.zeros(0, np.int32)}
            made["to_parent"] = away[order]
            return number
        pivots = points[random.choice(own, FANOUT, replace=False)]
        nearest = np.stack([space.apart(points[own], p) for p in pivots], 1).argmin(1)
        if len(np.unique(nearest)) == 1:
            nearest = np.arange(len(own)) % FANOUT
        parts = [(p, own[nearest == k]) for k, p in enumerate(pivots) if (nearest == k).any()]
        made |= {
            "ids": np.array([ids[part].min() for _, part in parts]),
            "vectors": np.stack([p for p, _ in parts]),
            "radii": np.array([space.apart(points[part], p).max() for p, part in parts]),
            "to_parent": np.array([0.0 if routing is None else float(space.apart(p, routing)) for p, _ in parts]),
        }
        made["children"] = np.array([page(part, p) for p, part in parts], np.int32)
        return number

    page(np.arange(len(ids)), None)
    return pages


class Search:
    """Best-first search of a block of queries over the pages of one tree.

    A page waits with the queries that may need it, and the page with the best bound of any of them is next. A leaf's
    entries are in the order of their distance to the routing point, so that the triangle inequality leaves each query
    one stretch of them, found by bisection.
    """

    def __init__(self, pages: dict[int, dict], space: Space) -> None:
        self.pages, self.space, self.margin = pages, space, space.margin()
        self.computed = self.passed_over = 0

    def top(
        self, own: np.ndarray, q: np.ndarray, k: int, score: np.ndarray, smallest: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place of the query, id, score) of at most k points for each query, without the query's own.

        score, smallest: a score and an id that a point must come before; minus infinity if there is no such bound.
        """
        whole = (q * q).sum(1) + self.space.square
        score, smallest = score.astype(np.float64).copy(), smallest.copy()
        found = [(np.empty(0), np.empty(0, np.int64)) for _ in own]

        def reach(who: np.ndarray) -> np.ndarray:
            """How far a point may lie to count."""
            return np.sqrt(np.maximum(0.0, whole[who] - 2 * score[who])) + self.margin

        def hopeful(best: np.ndarray, low: int, who: np.ndarray) -> np.ndarray:
            """Whether points that score ``best`` at most, with ids from ``low`` on, may count."""
            return (best > score[who]) | ((best == score[who]) & (low < smallest[who]))

        def take(who: int, points: np.ndarray, products: np.ndarray) -> None:
            products, points = np.concatenate([found[who][0], products]), np.concatenate([found[who][1], points])
            order = np.lexsort([points, -products])[:k]
            found[who] = products[order], points[order]
            if len(order) == k:
                score[who], smallest[who] = products[order[-1]], points[order[-1]]

        everyone = np.arange(len(own))
        queue: list[tuple] = [(-np.inf, 0, everyone, np.full(len(own), np.inf), np.full(len(own), -1.0), -(1 << 63))]
        while queue:
            _, number, who, best, away, low = heapq.heappop(queue)
            still = hopeful(best, low, who)
            who, away = who[still], away[still]
            if not len(who):
                continue
            page = self.pages[number]
            vectors = page["vectors"]
            if page["leaf"]:
                first, last = 0, len(vectors)
                if number:
                    far = reach(who)
                    start = np.searchsorted(page["to_parent"], away - far, "left")
                    stop = np.searchsorted(page["to_parent"], away + far, "right")
                    some = start < stop
                    who, first, last = who[some], start[some].min(initial=last), stop[some].max(initial=0)
                    if not len(who):
                        self.passed_over += len(some) * len(vectors)
                        continue
                self.computed += len(who) * (last - first)
                self.passed_over += len(who) * (len(vectors) - last + first)
                ids = page["ids"][first:last]
                products = q[who] @ vectors[first:last].T
                good = (products > score[who, None]) | ((products == score[who, None]) & (ids[None] < smallest[who, None]))
                good &= ids[None] != own[who, None]
                for i in np.flatnonzero(good.any(1)):
                    take(int(who[i]), ids[good[i]], products[i, good[i]])
                continue
            radii, entries = page["radii"], np.arange(len(vectors))
            far = reach(who)
            near = np.ones((len(who), len(vectors)), bool)
            if number:
                near = np.abs(away[:, None] - page["to_parent"][None]) - radii[None] <= far[:, None]
                entries = np.flatnonzero(near.any(0))
            self.computed += len(who) * len(entries)
            self.passed_over += len(who) * (len(vectors) - len(entries))
            distance = np.sqrt(np.maximum(0.0, whole[who, None] - 2 * (q[who] @ vectors[entries].T)))
            least = np.maximum(0.0, distance - radii[entries] - self.margin)
            bound = np.floor((whole[who, None] - least * least) / 2 + 1e-6)
            for j, entry in enumerate(entries):
                low = int(page["ids"][entry])
                ask = near[:, entry] & hopeful(bound[:, j], low, who)
                if ask.any():
                    best = bound[ask, j]
                    heapq.heappush(queue, (-best.max(), int(page["children"][entry]), who[ask], best, distance[ask, j], low))
        sizes = [len(f[1]) for f in found]
        return np.repeat(everyone, sizes), np.concatenate([f[1] for f in found]), np.concatenate([f[0] for f in found]).astype(np.int64)


def _pivots(points: DataFrame, trees: int, width: int, space: Space) -> np.ndarray:
    """Points of a bounded sample, each far from those before it."""
    sample = points.orderBy(F.xxhash64("id", F.lit("pivot")), "id").limit(4 * trees).select("v").toPandas()
    x = _matrix(sample.v, width)
    chosen, far = [0], space.apart(x, x[0])
    while len(chosen) < min(trees, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, space.apart(x, x[chosen[-1]]))
    return x[chosen]


def planted(points: DataFrame, space: Space, width: int, stage: Stage) -> tuple[DataFrame, DataFrame]:
    """(points with their tree, pages of all trees). No tree has more than about twice the even share of points."""
    count = points.count()
    trees = max(1, min(TREES // 2, -(-count // TREE_POINTS)))
    sent = points.sparkSession.sparkContext.broadcast(_pivots(points, trees, width, space))  # at most TREES / 2 rows

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, best, nearest = _matrix(batch.column(1).to_pylist(), width), None, None
            for k, pivot in enumerate(sent.value):
                d = space.apart(x, pivot)
                if best is None:
                    best, nearest = d, np.zeros(len(x), np.int32)
                else:
                    nearest, best = np.where(d < best, np.int32(k), nearest), np.minimum(best, d)
            yield pa.record_batch([*batch.columns, pa.array(nearest, pa.int32())], ["id", "v", "region"])

    regions = stage.keep(points.mapInArrow(assign, "id long, v array<int>, region int"))
    sizes = {r.region: r["count"] for r in regions.groupBy("region").count().collect()}  # a row for each pivot
    first, parts, share = {}, {}, -(-count // trees)
    for region in sorted(sizes):
        first[region] = sum(parts.values())
        parts[region] = -(-sizes[region] // (2 * share))
    spread = F.create_map(*[F.lit(x) for r in parts for x in (r, parts[r])])
    start = F.create_map(*[F.lit(x) for r in parts for x in (r, first[r])])
    tree = F.element_at(start, F.col("region")) + F.pmod(F.xxhash64("id"), F.element_at(spread, F.col("region")))
    dealt = regions.select("id", "v", tree.cast("int").alias("tree"))

    def grow(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        pages = build(frame.id.to_numpy(), _matrix(frame.v, width), space)
        rows = [p | {"tree": key[0], "vectors": p["vectors"].astype(np.int32).tobytes()} for p in pages]
        return pd.DataFrame(rows)[[f.split()[0] for f in PAGES.split(", ")]]

    return dealt, stage.keep(dealt.groupBy("tree").applyInPandas(grow, PAGES))


def _searched(pages: DataFrame, asked: DataFrame, space: Space, width: int, k: int, stage: Stage) -> DataFrame:
    """(query_id, id, score) for ``asked`` (id, v, tree, worst_score, worst_id), a tree and some queries at a time.

    A tree's pages are copied only for as many blocks of queries as ask for it.
    """
    asked = stage.keep(asked)
    blocks = asked.groupBy("tree").agg(F.ceil(F.count(F.lit(1)) / F.lit(QUERIES)).cast("int").alias("blocks"))
    queries = asked.join(blocks, "tree").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    copies = pages.join(blocks, "tree").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(left) and len(right):
            tree = {}
            for r in left.itertuples():
                vectors = np.frombuffer(r.vectors, np.int32).reshape(len(r.ids), -1).astype(np.float64)
                tree[r.page] = {"leaf": r.leaf, "ids": np.asarray(r.ids), "vectors": vectors, "radii": np.asarray(r.radii),
                                "to_parent": np.asarray(r.to_parent), "children": np.asarray(r.children)}
            q, ids = _matrix(right.v, width), right.id.to_numpy()
            score = right.worst_score.to_numpy(np.float64, na_value=-np.inf)
            smallest = right.worst_id.fillna(0).to_numpy(np.int64)
            place, own, scores = Search(tree, space).top(ids, q, k, score, smallest)
            return pd.DataFrame({"query_id": ids[place], "id": own, "score": scores})
        return pd.DataFrame({"query_id": [], "id": [], "score": []}, dtype="int64")

    left, right = copies.drop("blocks").groupBy("tree", "block"), queries.drop("blocks").groupBy("tree", "block")
    return left.cogroup(right).applyInPandas(search, FOUND)


def products(q: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores as longs, sizes) of q (one) with rows x, exact: sizes are the scores as doubles where those are beyond a long."""
    bound = np.abs(x) @ np.abs(q)
    scores, sizes = np.zeros(len(x), np.int64), np.zeros(len(x))
    small = bound < 1 << 52
    scores[small] = (x[small] @ q).astype(np.int64)
    whole = ~small & (bound < 1 << 62) & (np.abs(x).max(1, initial=0) < 1 << 62) & bool(np.abs(q).max(initial=0) < 1 << 62)
    scores[whole] = x[whole].astype(np.int64) @ q.astype(np.int64) if whole.any() else 0
    exact = [int(b) for b in q] if not np.all(small | whole) else []
    for i in np.flatnonzero(~(small | whole)):
        score = sum(int(a) * b for a, b in zip(x[i], exact, strict=True))
        scores[i] = max(-LONGEST, min(LONGEST, score))
        sizes[i] = float(score) if abs(score) > LONGEST else 0.0
    return scores, sizes


def _with_large(rows: DataFrame, query: str, width: int, count: int, k: int) -> DataFrame:
    """(query_id, id, score, size): the k best of each block for all pairs in which a vector is too large for trees.

    rows: what ``quantised`` gives; count: how many of them there are.
    """
    chunks = -(-count // BLOCK)
    large = rows.filter("large IS NOT NULL").select("id", "large", F.expr(f"coalesce({query}, false)").alias("asked"))
    blocks = -(-large.count() // LARGE_BLOCK)

    def dealt(frame: DataFrame, own: str, size: int, other: str, others: int) -> DataFrame:
        each = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return frame.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(size)).cast("int")).withColumn(other, each)

    def join(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            x, y = _matrix(left.x, width), _matrix(right.large, width)
            mine, theirs = left.id.to_numpy(), right.id.to_numpy()
            # Large queries with all rows; other queries with large rows.
            asked = [(theirs[i], y[i], mine, x) for i in np.flatnonzero(right.asked)]
            asked += [(mine[i], x[i], theirs, y) for i in np.flatnonzero(left.asked & ~left.is_large)]
            for own, q, ids, points in asked:
                scores, sizes = products(q, points)
                order = np.lexsort([ids, -sizes, -scores])
                order = order[ids[order] != own][:k]
                out.append(pd.DataFrame({"query_id": own, "id": ids[order], "score": scores[order], "size": sizes[order]}))
        nothing = pd.DataFrame({"query_id": [], "id": [], "score": [], "size": []}).astype({"query_id": "int64", "id": "int64", "score": "int64"})
        return pd.concat(out) if out else nothing

    x = F.coalesce("large", F.col("v").cast("array<double>")).alias("x")
    every = rows.select("id", x, F.expr(f"coalesce({query}, false)").alias("asked"), F.expr("large IS NOT NULL").alias("is_large"))
    left = dealt(every, "chunk", chunks, "block", blocks).groupBy("chunk", "block")
    right = dealt(large, "block", blocks, "chunk", chunks).groupBy("chunk", "block")
    return left.cogroup(right).applyInPandas(join, FOUND_LARGE)


def top_k(
    vectors: DataFrame, query: str, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0
) -> DataFrame:
    """(query_id, rank, id, score): the k highest inner products of each row for which ``query`` (SQL on id) holds."""
    stage = Stage(vectors.sparkSession)
    rows = stage.keep(quantised(vectors, id_col, vector_col, scale))
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("size"), "id")
    every = rows.agg(F.count("large").alias("large"), F.count("id").alias("rows"), F.max(F.greatest(F.size("v"), F.size("large"))).alias("width")).first()
    best = _in_trees(rows.filter("v IS NOT NULL").select("id", "v"), query, k, stage).withColumn("size", F.lit(0.0))
    if every.large:
        best = best.unionByName(_with_large(rows, query, max(1, every.width), every.rows, k))
    best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")


def _in_trees(points: DataFrame, query: str, k: int, stage: Stage) -> DataFrame:
    """(query_id, id, score): the k best, and some more, of the pairs of ``points`` (id, v)."""
    spark = points.sparkSession
    told = points.agg(
        F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda n, x: n + x.cast("double") * x)).alias("square"),
        F.max(F.expr(f"CAST({query} AS INT)")).alias("queries"),
    ).first()
    if not told.queries:
        return spark.createDataFrame([], FOUND)
    width, space = max(1, told.width), Space(told.square)
    dealt, pages = planted(points, space, width, stage)
    queries = dealt.filter(query)
    nothing = F.lit(None).cast("long")
    own = queries.select("*", nothing.alias("worst_score"), nothing.alias("worst_id"))
    near = stage.keep(_searched(pages, own, space, width, k, stage))
    ranked = W.partitionBy("query_id").orderBy(F.desc("score"), "id")
    worst = near.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == k)
    worst = worst.select("query_id", F.col("score").alias("worst_score"), F.col("id").alias("worst_id"))
    bounded = queries.join(worst, queries.id == worst.query_id, "left").drop("query_id")
    roots = [(r.tree, np.frombuffer(r.vectors, np.int32).reshape(len(r.ids), -1).astype(np.float64), np.array(r.radii), r.leaf)
             for r in pages.filter("page = 0").collect()]
    sent = spark.sparkContext.broadcast(roots)  # at most TREES pages

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin = space.margin()
        for batch in batches:
            q = _matrix(batch.column(1).to_pylist(), width)
            home = batch.column(2).to_numpy()
            bar = batch.column(3).to_numpy(zero_copy_only=False).astype(np.float64)
            whole = (q * q).sum(1) + space.square
            reach = np.where(np.isnan(bar), np.inf, np.sqrt(np.maximum(0.0, whole - 2 * np.nan_to_num(bar)))) + margin
            for tree, entries, radii, _ in sent.value:
                away = np.sqrt(np.maximum(0.0, whole[:, None] - 2 * (q @ entries.T)))
                near = np.flatnonzero(((away - radii <= reach[:, None]).any(1)) & (home != tree))
                if len(near):
                    taken = batch.take(pa.array(near))
                    columns = [taken.column(0), taken.column(1), pa.array(np.full(len(near), tree), pa.int32()), *taken.columns[3:]]
                    yield pa.record_batch(columns, batch.schema.names)

    ordered = bounded.select("id", "v", "tree", "worst_score", "worst_id")
    schema = "id long, v array<int>, tree int, worst_score long, worst_id long"
    far = _searched(pages, ordered.mapInArrow(others, schema), space, width, k, stage)
    return near.unionAll(far)
