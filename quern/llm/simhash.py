"""Near-duplicate texts by 64-bit fingerprints of word shingles.

Two fingerprints that differ in at most three bits have a half that differs in at most one. Each half is indexed as it
is and with one bit left out, for each bit: fingerprints with such a half in common meet under an equal key, and are
then verified. A key of two fingerprints is verified in the aggregation itself. Larger ones are cut into blocks of
bounded size, each pair of blocks is compared in one place, and only a spanning forest of the links found is returned,
so that a hot key costs neither a large task nor a row for each pair.

Defined results: a null or blank text has no words and fingerprint zero, linked like any other. Repeated rows share
a component. A null id keeps its row; the component's id is then the smallest other one (null if there is none). An
empty table gives no rows. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import Stage, by_batch, byte_words, components

#: Shingles whose bits are counted at a time.
_STRIP = 1 << 18
#: Members of a block; a task holds two blocks.
BLOCK = 1024


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text as an unsigned number: the majority of each bit over the hashes of its shingles."""
    own = byte_words(text)
    own = b"\n".join(own).lower().split(b"\n") if own else own
    if not own:
        return 0
    width = min(words, len(own))
    shingles = map(b" ".join, zip(*(islice(own, k, None) for k in range(width)), strict=False))
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    total, ones = len(own) - width + 1, np.zeros(64, np.int64)
    for start in range(0, total, _STRIP):
        strip = np.fromiter(islice(hashes, _STRIP), "<u8", count=min(_STRIP, total - start))
        ones += np.unpackbits(strip.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint) with the fingerprint's 64 bits as a signed long."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64)
        return pa.record_batch([batch.column(0).cast(pa.int64()), pa.array(prints.view(np.int64))], ["id", "fingerprint"])

    return by_batch(docs.select(F.col(id_col).cast("long"), text_col), make, "id long, fingerprint long")


def _variants(prints: DataFrame) -> DataFrame:
    """(key, value) for both halves whole and with each bit left out; the half in question leads in ``value``."""
    turned = "(shiftleft(fingerprint, 32) | shiftrightunsigned(fingerprint, 32))"
    return (
        prints.select("fingerprint", F.explode(F.sequence(F.lit(0), F.lit(65))).alias("v"))
        .selectExpr("v", "v % 33 AS bit", f"IF(v < 33, fingerprint, {turned}) AS value")
        .selectExpr(
            "shiftleft(CAST(v AS BIGINT), 32) | (shiftrightunsigned(value, 32)"
            " & ~IF(bit = 32, 0L, shiftleft(1L, bit))) AS key",
            "value",
        )
    )


#: Whether a key has more to say than that of the whole half: its members differ in the bit left out.
_TELLS = "(shiftright(key, 32) % 33 = 32 OR shiftrightunsigned(low ^ high, 32) != 0)"


def _upright(value: str) -> str:
    """The fingerprint of a variant's value."""
    return f"IF(shiftright(key, 32) < 33, {value}, shiftleft({value}, 32) | shiftrightunsigned({value}, 32))"


def _forest(values: np.ndarray, side: np.ndarray, cross: bool, halves: bool, bits: int) -> np.ndarray:
    """Pairs of places in ``values`` that span the components of the links.

    cross: only values of different sides are compared. halves: only those that differ in the leading half.
    """
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= bits
    if cross:
        near &= side[:, None] != side[None, :]
    if halves:
        top = values >> np.uint64(32)
        near &= top[:, None] != top[None, :]
    left, pairs = np.ones(len(values), bool), []
    for root in range(len(values)):
        if not left[root]:
            continue
        left[root], edge = False, np.array([root])
        while len(edge):
            edge = np.flatnonzero(near[edge].any(0) & left)
            left[edge] = False
            pairs.append(np.stack([np.full(len(edge), root), edge], 1))
    return np.concatenate(pairs)


def _compare_blocks(bits: int):
    """Tasks that get rows of a block pair next to each other and return the forests of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # rows of the last group, which the next batch may go on with

        def solve(rows: np.ndarray) -> list[np.ndarray]:
            cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(1)) + 1
            out = []
            for part in np.split(rows, cuts):
                key, first, second = part[0, :3]
                values = part[:, 4].view(np.uint64) if part.flags.c_contiguous else part[:, 4].astype(np.int64).view(np.uint64)
                pairs = _forest(values, part[:, 3], first != second, (key >> 32) % 33 != 32, bits)
                if len(pairs):
                    turn = (key >> 32) >= 33
                    flat = (values << np.uint64(32)) | (values >> np.uint64(32)) if turn else values
                    out.append(flat[pairs].view(np.int64))
            return out

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(5)], 1)
            if held:
                rows = np.concatenate([*held, rows])
            last = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(1))
            cut = last[-1] + 1 if len(last) else 0
            held = [np.ascontiguousarray(rows[cut:])]
            for pairs in solve(np.ascontiguousarray(rows[:cut])) if cut else []:
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
        if held:
            for pairs in solve(held[0]):
                yield pa.record_batch([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return run


def links(prints: DataFrame, stage: Stage, bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints whose components are those of all links of at most ``bits`` bits."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with one bit left out find up to three differing bits")
    variants = _variants(prints)
    keys = stage.keep(
        variants.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .filter(f"n > 1 AND {_TELLS}")
    )
    twos = keys.filter(f"n = 2 AND bit_count(low ^ high) <= {bits}").selectExpr(
        f"{_upright('low')} AS a", f"{_upright('high')} AS b"
    )
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    many = keys.filter("n > 2").select("key", parts.alias("parts"))
    members = variants.join(many, "key").withColumn("side", F.expr("CAST(pmod(xxhash64(value), parts) AS INT)"))
    dealt = members.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)"))).selectExpr(
        "key", "least(side, other) AS first", "greatest(side, other) AS second", "side", "value"
    )
    found = (
        dealt.repartition("key", "first", "second")
        .sortWithinPartitions("key", "first", "second")
        .mapInArrow(_compare_blocks(bits), "a long, b long")
    )
    return twos.unionAll(found)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bits: int = 3, block: int = BLOCK
) -> DataFrame:
    """(id, fingerprint long, component long): the smallest id that links of at most ``bits`` bits reach."""
    stage = Stage(docs.sparkSession)
    own = stage.keep(fingerprints(docs, id_col, text_col, words))
    least = own.groupBy("fingerprint").agg(F.min("id").alias("least"))
    # Dealt once more, since each row becomes 66: tasks sized by these narrow rows would be too large. Not by the
    # fingerprint, as they are dealt by that already and would be left as they are.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = own.select("fingerprint").distinct().repartition(parts)
    roots = components(links(distinct, stage, bits, block), stage)
    joined = least.join(roots, least.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    joined = stage.keep(joined)
    whole = joined.groupBy("root").agg(F.min("least").alias("component"))
    return own.join(joined.join(whole, "root").select("fingerprint", "component"), "fingerprint").select(
        "id", "fingerprint", "component"
    )
