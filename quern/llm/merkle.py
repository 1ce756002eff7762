"""A Merkle manifest of a table: eight-ary hash trees, one per group and one over the groups' roots, and octopus proofs.

``Manifest.of`` numbers the leaves of each group along their order, by ranges, without a sorter of all; builds the trees from
blocks of consecutive nodes, ``DEPTH`` levels a job; and keeps leaves and nodes as tables in the shared folder.

``Manifest.proofs`` proves any set of leaves. They are dealt out by blocks of consecutive leaves. A block computes, level
by level and from positions alone, the smallest set of nodes that its proofs need and that do not follow from its own
leaves or from one another (an octopus multiproof). These coordinates are fetched with one join for all blocks; a block
then derives the inner nodes that its proofs share once, and expands each leaf's own proof from them.

No task holds more than one block and a few nodes for each level above it, however large the table or a group is.

Digests H are lowercase hex SHA-256; H of several digests is that of their hex texts, joined. A run of fewer than eight
nodes at the end of a level is hashed like any other, even one node. A tree of one leaf has that leaf as its root.

Defined results: a null group is a tree of its own, before all others; groups are in the order of their bytes. Null ids
come first in their tree; rows of one id are ordered by their leaves, and equal leaves by chance among equals: their
proofs go to the right leaf, but which of the equal rows gets which place is open. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.shared import Stage

ARITY = 8
#: Levels that one block of consecutive nodes covers: 4,096 nodes.
DEPTH = 4
#: The tree over the roots of the groups.
TOP = -1
#: Leaves numbered together.
RANGE_ROWS = 200_000
#: More ranges than this are not made: they grow instead.
MOST_RANGES = 10_000


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with the number of its bytes before it; ``-`` for none."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def parents(nodes: dict[int, str], n: int) -> dict[int, str]:
    """The nodes above whole runs of a level of ``n`` nodes; every run that is begun must be whole."""
    runs: dict[int, list[str]] = {}
    for place in sorted(nodes):
        runs.setdefault(place // ARITY, []).append(nodes[place])
    assert all(len(x) == min(ARITY, n - run * ARITY) for run, x in runs.items()), "a run lacks nodes"
    return {run: digest(x) for run, x in runs.items()}


def levels(n: int) -> list[int]:
    """The number of nodes of each level of a tree, leaves first, down to 1."""
    found = [n]
    while found[-1] > 1:
        found.append(-(-found[-1] // ARITY))
    return found


def missing(places: np.ndarray, n: int) -> list[tuple[int, int]]:
    """(level, place) of the fewest nodes from which, with leaves at ``places``, the root of ``n`` leaves follows."""
    known, found = np.unique(places), []
    for level, size in enumerate(levels(n)[:-1]):
        runs = np.unique(known // ARITY)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        found += [(level, int(p)) for p in np.setdiff1d(members[members < size], known)]
        known = runs
    return found


def climb(leaves: dict[int, str], fetched: dict[tuple[int, int], str], n: int) -> list[dict[int, str]]:
    """All nodes known at each level: given ones, fetched ones, and those that follow from them."""
    known, found = dict(leaves), []
    for level, size in enumerate(sizes := levels(n)):
        known |= {p: h for (at, p), h in fetched.items() if at == level}
        found.append(known)
        if level + 1 < len(sizes):
            known = parents(known, size)
    return found


def siblings(known: list[dict[int, str]], place: int, n: int) -> list[tuple[int, list[str]]]:
    """For each level below the root: the place in its run, and the other members of the run."""
    path = []
    for level, size in enumerate(levels(n)[:-1]):
        first = place - place % ARITY
        members = range(first, min(first + ARITY, size))
        path.append((place - first, [known[level][p] for p in members if p != place]))
        place //= ARITY
    return path


def folded(node: str, path: list[tuple[int, list[str]]]) -> str:
    """The root that follows from a leaf and the siblings on its way."""
    for place, others in path:
        node = digest([*others[:place], node, *others[place:]])
    return node


def _numbered(stage: Stage, leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``tree``, ``place`` in it and ``n``, the leaves of the tree.

    Rows are range-partitioned along (group, id, leaf) and numbered inside their range while they are written; what lies
    before a range, within its group, is joined from the counts of the ranges.
    """
    once = stage.keep(leaves.withColumn("__source", F.monotonically_increasing_id()))
    count = min(MOST_RANGES, max(1, -(-once.count() // RANGE_ROWS)))
    order = [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("__source")]
    ranged = once.repartitionByRange(count, *order).sortWithinPartitions(*order).drop("__source")
    written = stage.keep(ranged.withColumn("__at", F.monotonically_increasing_id()))
    stage.drop(once)
    # The upper bits of __at are the range, the lower 33 the place in it.
    part = F.shiftright("__at", 33).cast("int")
    sizes = written.groupBy("group", part.alias("__part")).agg(
        F.count(F.lit(1)).alias("__rows"), F.min("__at").alias("__first")
    )
    # A row for each range that a group reaches into.
    of_group, so_far = W.partitionBy("group"), W.partitionBy("group").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        F.col("group").alias("__group"), "__part", "__first",
        F.coalesce(F.sum("__rows").over(so_far), F.lit(0)).alias("__before"), F.sum("__rows").over(of_group).alias("n"),
    )
    same = F.col("group").eqNullSafe(F.col("__group")) & (part == F.col("__part"))
    return written.join(sizes, same).select(
        *leaves.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("place"), "n"
    )


NODES = "tree long, level int, place long, node string, n long"


def _inner(nodes: DataFrame, level: int, depth: int) -> DataFrame:
    """The up to ``depth`` levels above the nodes of ``level``; ``n`` is the size of each node's level."""

    def build(table: pa.Table) -> pa.Table:
        tree, n = table.column("tree")[0].as_py(), table.column("n")[0].as_py()
        known = dict(zip(table.column("place").to_pylist(), table.column("node").to_pylist(), strict=True))
        out: list[tuple] = []
        for step in range(depth):
            if n == 1:
                break
            known, n = parents(known, n), -(-n // ARITY)
            out += [(tree, level + step + 1, p, h, n) for p, h in known.items()]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kind, strict=True)], schema=kind)

    kind = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("node", pa.string()), ("n", pa.int64())])
    grown = nodes.filter("n > 1").withColumn("block", F.expr(f"place div {ARITY**depth}"))
    return grown.groupBy("tree", "block").applyInArrow(build, NODES)


def _trees(stage: Stage, nodes: DataFrame, depth: int) -> list[DataFrame]:
    """Tables of all inner nodes above the leaves ``nodes`` (tree, place, node, n), each of ``depth`` levels."""
    tables, level = [], 0
    while (nodes.agg(F.max("n")).first()[0] or 0) > 1:
        tables.append(stage.keep(_inner(nodes, level, depth)))
        level += depth
        nodes = tables[-1].filter(F.col("level") == level)
    return tables


@dataclass
class Manifest:
    """leaves: id, leaf, tree, place, n, further columns; nodes: tree, level, place, node, n, with the leaves as level 0;
    groups: tree, group, its root and the number of leaves."""

    stage: Stage
    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    depth: int = DEPTH

    @classmethod
    def of(cls, rows: DataFrame, depth: int = DEPTH) -> Manifest:
        """Of rows (group string, id long, leaf string, further columns)."""
        stage = Stage(rows.sparkSession)
        placed = _numbered(stage, rows)
        # The groups themselves are numbered as one group, in the order of their bytes.
        known = placed.groupBy("group").agg(F.max("n").alias("size"))
        named = known.select(F.lit("").alias("group"), F.lit(0).cast("long").alias("id"), F.coalesce("group", F.lit("")).alias("leaf"),
                             F.col("group").isNotNull().alias("named"), "size")
        named = named.withColumn("leaf", F.concat(F.when(F.col("named"), "1").otherwise("0"), "leaf"))
        groups = stage.keep(
            _numbered(stage, named).select(
                F.col("place").alias("tree"), F.when(F.col("named"), F.expr("substring(leaf, 2)")).alias("group"), "size",
                F.col("n").alias("groups"),
            )
        )
        keyed = placed.join(groups.select("tree", F.col("group").alias("__group")), F.col("group").eqNullSafe(F.col("__group")))
        leaves = stage.keep(keyed.drop("__group"))
        low = leaves.select("tree", F.lit(0).alias("level"), "place", F.col("leaf").alias("node"), "n")
        inner = _trees(stage, low.drop("level"), depth)
        nodes = low
        for table in inner:
            nodes = nodes.unionByName(table)
        roots = nodes.filter("n = 1").select("tree", F.col("node").alias("subroot"))
        subroots = stage.keep(groups.join(roots, "tree"))
        top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("place"),
                              F.col("subroot").alias("node"), F.col("groups").alias("n"))
        nodes = nodes.unionByName(top)
        for table in _trees(stage, top.drop("level"), depth):
            nodes = nodes.unionByName(table)
        return cls(stage, leaves, nodes, subroots, depth)

    def proofs(self, wanted: DataFrame | None = None, other_col: str | None = None) -> DataFrame:
        """(id, leaf, subroot, root, proof, folded) of leaves; ``wanted`` are rows of ``leaves``, all if not given.

        proof: H of all siblings from the leaf up to the root, from left to right in each level. folded: the root that
        follows from ``other_col`` in place of the leaf where that is not null, and from the leaf elsewhere.
        """
        leaves = self.leaves if wanted is None else wanted
        other = F.col(other_col) if other_col else F.lit(None).cast("string")
        size = self.groups.select("tree", "groups")
        rows = leaves.select("tree", F.expr(f"place div {ARITY**self.depth}").alias("block"), "place", "n", "id", "leaf", other.alias("other"))
        rows = rows.join(size, "tree")
        asked = rows.select("tree", "block", "place", "n", "groups").groupBy("tree", "block").applyInArrow(_asked, ASKED)
        at = [F.col("of") == F.col("tree"), F.col("level") == F.col("on"), F.col("spot") == F.col("place")]
        # Whole blocks know all nodes below their own top.
        nodes = self.nodes.filter((F.col("level") >= self.depth) | (F.col("tree") == TOP)) if wanted is None else self.nodes
        found = asked.join(nodes, at[0] & at[1] & at[2]).select("for_tree", "block", "of", "on", "spot", "node")
        asking = rows.groupBy("tree", "block").cogroup(found.groupBy("for_tree", "block"))
        return asking.applyInArrow(_expanded, PROOFS)


ASKED = "for_tree long, block long, of long, on int, spot long"
PROOFS = "id long, leaf string, subroot string, root string, proof string, folded string"


def _asked(table: pa.Table) -> pa.Table:
    """The nodes that the proofs of a block need: in its own tree, and in that of the groups."""
    tree, block, n, groups = (table.column(c)[0].as_py() for c in ("tree", "block", "n", "groups"))
    own = [(tree, block, tree, at, p) for at, p in missing(table.column("place").to_numpy(), n)]
    above = [(tree, block, TOP, at, p) for at, p in missing(np.array([tree]), groups)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    rows = own + above
    columns = zip(*rows, strict=True) if rows else [()] * 5
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["for_tree", "block", "of", "on", "spot"])


def _expanded(block: pa.Table, found: pa.Table) -> pa.Table:
    """Each leaf's own proof, from the block's leaves and what was fetched for it."""
    names = ["id", "leaf", "subroot", "root", "proof", "folded"]
    if not block.num_rows:
        return pa.table([pa.array([], t) for t in (pa.int64(), *[pa.string()] * 5)], names)
    tree, n, groups = (block.column(c)[0].as_py() for c in ("tree", "n", "groups"))
    fetched: dict[bool, dict] = {True: {}, False: {}}
    for of, on, spot, node in zip(*(found.column(c).to_pylist() for c in ("of", "on", "spot", "node")), strict=True):
        fetched[of == TOP][on, spot] = node
    places, leaves = block.column("place").to_pylist(), block.column("leaf").to_pylist()
    known = climb(dict(zip(places, leaves, strict=True)), fetched[False], n)
    subroot = known[-1][0]
    above = climb({tree: subroot}, fetched[True], groups)
    root, tail = above[-1][0], siblings(above, tree, groups)
    proofs, roots = [], []
    for place, own, other in zip(places, leaves, block.column("other").to_pylist(), strict=True):
        path = siblings(known, place, n) + tail
        proofs.append(digest(h for _, others in path for h in others))
        roots.append(folded(own if other is None else other, path))
    same = [pa.array([x] * len(places), pa.string()) for x in (subroot, root)]
    columns = [block.column("id").combine_chunks(), pa.array(leaves, pa.string()), *same, pa.array(proofs), pa.array(roots)]
    return pa.table([pa.array(c) if not isinstance(c, pa.Array) else c for c in columns], names)
