"""Line deduplication, conversation repair and Merkle manifests against plain versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import dialogue, lines, merkle, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def no_python(df):
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def plain_lines(rows, least=20, documents=3):
    """(id, lines, dropped, text left) of each (id, text)."""
    holders = defaultdict(set)
    order = lambda i: (i is not None, i or 0)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[line.strip(BLANKS).translate(LOWER)].add(i)
    out = []
    for i, text in rows:
        every = (text or "").split("\n")
        gone = [
            len(k) >= least and len(holders[k]) >= documents and max(holders[k], key=order) != i
            for k in (line.strip(BLANKS).translate(LOWER) for line in every)
        ]
        out.append((i, len(every), sum(gone), "\n".join(x for x, g in zip(every, gone, strict=True) if not g)))
    return out


def line_rows():
    chance = random.Random(5)
    pool = [f"shared line number {k} with enough letters É" for k in range(12)] + ["short", "", "  "]
    rows = []
    for i in range(150):
        text = []
        for _ in range(chance.randrange(0, 9)):
            line = chance.choice(pool) if chance.random() < 0.6 else f"own line {chance.random()} of this text"
            text.append(chance.choice([line, line.upper(), f" \t{line}\r", line.title()]))
        rows.append((chance.choice([i, i, i, 7, None]), "\n".join(text) if text else chance.choice([None, ""])))
    hot = "This line is in a third of all documents, or more."
    rows += [(1000 + i, f"{hot}\nown {i}\n{hot}") for i in range(120)] + [(1003, f"{hot}\nanother text"), (1003, f"{hot}\nown 3\n{hot}")]
    return [*rows, (5000, "\n".join(f"line of a very long text {k % 700}" for k in range(20_000))), (4000, "line of a very long text 6\n\n"), (4001, "Line of a very long text 6")]


def test_lines(docs_of):
    rows = line_rows()
    found = lines.without_shared_lines(docs_of(*rows).repartition(5))
    no_python(found)
    got = found.select("doc_id", "n_lines", "n_dropped", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain_lines(rows), key=str)
    digests = lines.digests(docs_of(*rows)).collect()
    want = [(*r[:3], hashlib.sha256(r[3].encode()).hexdigest()) for r in plain_lines(rows)]
    assert sorted(map(tuple, digests), key=str) == sorted(want, key=str)


def test_lines_of_awkward_rows(awkward, clashing, empty):
    for docs in (awkward, clashing):
        found = lines.without_shared_lines(docs)
        assert found.count() == docs.count() and {*docs.columns} <= {*found.columns}
        for r in found.filter("doc_id = 3").collect():
            assert (r.n_lines, r.n_dropped, r.kept, r.text) == (1, 0, "", None)
    replaced = lines.without_shared_lines(clashing.withColumn("kept", F.lit(1)), out_col="text")
    assert replaced.columns.count("text") == 1
    assert lines.without_shared_lines(empty).count() == 0


def damage(rows):
    """Rows (turn, role, text) of one conversation after the damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


FOLLOW = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def faults_of(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANKS)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def plain_repair(rows):
    """All edits of what follows, tried in each state from the last row to the first."""
    faults, initials = faults_of(rows), [r[1][:1] for r in rows]

    def with_insertions(best):
        for _ in range(4):
            for (state, _), to in FOLLOW.items():
                if to != 1 and to in best:
                    found = (best[to][0] + 5, "I" + best[to][1])
                    best[state] = min(best.get(state, found), found)
        return best

    best = with_insertions({0: (0, ""), 3: (0, "")})
    for fault, initial in zip(faults[::-1], initials[::-1], strict=True):
        options = defaultdict(list)
        for state in best:
            options[state].append((best[state][0] + 2, "D" + best[state][1]))
        cut = 5 if fault == "truncated" else 0
        for (state, c), to in FOLLOW.items():
            if fault not in ("blank", "duplicate") and to in best:
                if c == initial:
                    options[state].append((best[to][0] + cut, "K" + best[to][1]))
                if c != "s":
                    options[state].append((best[to][0] + cut + 1, "R" + best[to][1]))
        best = with_insertions({state: min(x) for state, x in options.items()})
    cost, audit = best[0]
    size = len(audit) - audit.count("D")
    roles = ["system"] * (size % 2) + ["user", "assistant"] * (size // 2)
    out, at = [], 0
    for letter in audit:
        if letter == "I":
            out.append(("I", roles[len(out)], ""))
            continue
        _, role, text = rows[at]
        at += 1
        if letter != "D":
            if letter == "K":
                assert role[:1] == roles[len(out)][0]
            out.append((letter, role if letter == "K" else roles[len(out)], text))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    text = "\n".join(f"{role}:{text}" for _, role, text in out)
    sums = [faults.count(x) for x in ("blank", "duplicate", "truncated")]
    return (gaps, *sums, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()), out


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def conversation_rows():
    chance = random.Random(11)
    texts = ["Yes.", "No", "What?", "", " \t", None, "one two", "done!", "x. ", "é?", "yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"]
    rows = []
    for conv in [None, *range(120)]:
        for k in range(chance.randrange(1, 14)):
            turn = chance.choice([k, k, k, k, k + 2, 3, None])
            rows.append((conv, turn, chance.choice(roles[: chance.choice([2, 4, 9])]), chance.choice(texts) if chance.random() < 0.5 else f"text {chance.random()}."))
    # One conversation with far more rows than a batch holds, and repeats of one row.
    rows += [(500, k, ["user", "assistant"][k % 2], f"row {k % 400}" + "."[: k % 3]) for k in range(3000)]
    return rows + [(501, 4, "user", "the same.")] * 30 + [(500, 17, "user", "row 17.")] * 3


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_conversations(spark, small_batches):
    rows = conversation_rows()
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(3).withColumn("conv", F.lit("clash"))
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = {conv: plain_repair(damage(own)) for conv, own in by.items()}
    got = {r[0]: tuple(r)[1:] for r in dialogue.summaries(queries.damaged(df)).collect()}
    assert got == {conv: x[0] for conv, x in want.items()}
    assert all(re.fullmatch("(s?(ua)+)?", "".join(role[:1] for _, role, _ in x[1])) for x in want.values())
    written = defaultdict(list)
    for r in sorted(dialogue.repaired(queries.damaged(df)).collect(), key=lambda r: (str(r.conv_id), r.place)):
        assert r.place == len(written[r.conv_id])
        written[r.conv_id].append((r.edit, r.role, r.text))
    assert written == {conv: x[1] for conv, x in want.items() if x[1]}


def test_conversations_in_one_shuffle(spark):
    df = spark.createDataFrame([(1, 1, "user", "a")], CONVERSATIONS)
    plan = dialogue.summaries(queries.damaged(df))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1
    assert dialogue.summaries(dialogue.present(df.limit(0))).count() == 0
    kept = dialogue.summaries(dialogue.present(df)).first()
    assert (kept.cost, kept.audit, kept.truncated) == (2, "D", 1)


def tree_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([merkle.digest(levels[-1][k : k + 8]) for k in range(0, len(levels[-1]), 8)])
    return levels


def path_of(levels, place):
    for nodes in levels[:-1]:
        first = place - place % 8
        yield place - first, [h for k, h in enumerate(nodes[first : first + 8]) if first + k != place]
        place //= 8


def plain_proofs(rows):
    """Sorted (id, leaf, subroot, root, proof, folded) of (group, id, leaf, other)."""
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    groups = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    for g in groups:
        by[g].sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    trees = {g: tree_of([r[2] for r in by[g]]) for g in groups}
    top = tree_of([trees[g][-1][0] for g in groups])
    out = []
    for k, g in enumerate(groups):
        for place, (_, i, leaf, other) in enumerate(by[g]):
            path = [*path_of(trees[g], place), *path_of(top, k)]
            node = leaf if other is None else other
            for at, others in path:
                node = merkle.digest([*others[:at], node, *others[at:]])
            out.append((i, leaf, trees[g][-1][0], top[-1][0], merkle.digest(h for _, o in path for h in o), node))
    return sorted(out, key=str)


LEAVES = "`group` string, id long, leaf string, other string"


def leaf_rows():
    rows = [("en", i, merkle.digest([str(i)]), merkle.digest(["x", str(i)]) if i % 3 == 0 else None) for i in range(700)]
    rows += [(f"g{k}", i, merkle.digest([str(k), str(i)]), None) for k in range(11) for i in range(k)]
    rows += [(None, 5, "n", None), ("", 6, "e", None), ("é", None, "null", None), ("é", 1, "b", None), ("é", 1, "a", None)]
    return rows + [("copies", 9, "same", None)] * 130


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_manifest(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "RANGE_ROWS", 60)
    rows = leaf_rows()
    df = spark.createDataFrame(rows, LEAVES).repartition(3).withColumn("place", F.lit("clash")).drop("place")
    manifest = merkle.Manifest.of(df, depth)
    got = manifest.proofs(other_col="other").collect()
    assert sorted(map(tuple, got), key=str) == plain_proofs(rows)
    some = manifest.proofs(manifest.leaves.filter("id % 7 = 3"), "other").collect()
    assert sorted(map(tuple, some), key=str) == [r for r in plain_proofs(rows) if r[0] is not None and r[0] % 7 == 3]


def test_manifest_of_one_leaf_and_of_none(spark):
    df = spark.createDataFrame([("a", 1, "x", None)], LEAVES)
    found = merkle.Manifest.of(df).proofs().first()
    assert (found.subroot, found.root, found.folded, found.proof) == ("x", "x", "x", merkle.digest([]))
    assert merkle.Manifest.of(df.limit(0)).proofs().count() == 0


def test_fewest_nodes():
    random_ = np.random.default_rng(3)
    for n in (1, 2, 8, 9, 64, 65, 700, 5000):
        leaves = [str(k) for k in range(n)]
        levels = tree_of(leaves)
        for _ in range(4):
            places = random_.choice(n, int(random_.integers(1, min(n, 40) + 1)), replace=False)
            asked = merkle.missing(places, n)
            fetched = {(at, p): levels[at][p] for at, p in asked}
            known = merkle.climb({int(p): leaves[p] for p in places}, fetched, n)
            assert known[-1][0] == levels[-1][0]
            # None of them lies above a leaf that is proven or above another one, so none could be left out.
            above = {(at, int(p) // 8**at) for p in places for at in range(len(levels))}
            above |= {(at + up, p // 8**up) for at, p in asked for up in range(1, len(levels) - at)}
            assert not above & set(asked)


def test_leaf_digests(spark):
    df = spark.createDataFrame([(1, "é", None)], "a long, b string, c string")
    found = df.select(merkle.leaf(F.col("a"), F.col("b"), F.col("c")).alias("h")).first().h
    assert found == hashlib.sha256("1:12:é-".encode()).hexdigest()
