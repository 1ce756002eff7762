"""Documents in shards of near equal bytes: a minimax contiguous partition of ordered, indivisible groups.

Groups are equal texts, ordered by a hash of the text. A group larger than an even share is given a shard of its own
(there are fewer of these than shards). The others are cut into contiguous runs: the smallest capacity for which filling
shard after shard succeeds is found by binary search, and the cuts are made there.

The search runs on the driver over a bounded summary: group sizes added up in cells of the hash's range. For a range of
capacities, where the j-th cut can lie is bounded from both sides; the cells in question are cut finer, by another job
over the narrow table of groups, until each holds one group. So the result is exact, whatever the number of groups.

Slots number the rows of each shard without gaps. Rows are dealt to sub-cells by a hash of their id, counted, and
numbered inside their sub-cell, so that neither a shard nor a group is one task.

Defined results: a null text has the bytes of none and counts as one group of its own (all null texts stay together).
An empty text is a group like any other. A null id keeps its row. Repeated rows get a slot each. An empty table gives
no rows. Columns other than those named are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.shared import Stage

#: Bytes that each row takes beside its text.
ROW_BYTES = 8
#: The order of groups runs from 0 to below 2 to this power.
ORDER_BITS = 62
#: Cells of the first summary, and of each stretch that is looked at again, as powers of two.
FIRST_CELLS, FINER_CELLS = 13, 10
#: Rows that are numbered together.
SUBCELL_ROWS = 5_000


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(text.isNull(), F.lit(0).cast("long"))
        .otherwise(F.shiftrightunsigned(F.xxhash64(text), 64 - ORDER_BITS))
        .alias("place"),
    )


class _Cells:
    """Sizes of consecutive stretches of the order; each is one group or may be cut further."""

    def __init__(self, rows: list[tuple[int, int, int, bool]]) -> None:
        self.rows = sorted(rows)  # (first place, place behind the last, size, whether it is one group)

    def fill(self, capacity: int, shards: int, cut_any: bool) -> tuple[bool, list[tuple[int, int]]]:
        """Fill shard after shard. Returns whether all fits, and for each cut its cell and the bytes of it taken.

        cut_any: cells of several groups can be cut at any byte, which is the best that they can do; otherwise none
        can be cut, the worst.
        """
        cuts, room, k, taken = [], capacity, 0, 0
        while k < len(self.rows):
            size, single = self.rows[k][2] - taken, self.rows[k][3]
            if size <= room:
                room, k, taken = room - size, k + 1, 0
                continue
            if cut_any and not single:
                taken += room
            elif room == capacity:
                return False, cuts
            cuts.append((k, taken))
            if len(cuts) == shards:
                return False, cuts
            room = capacity
        return True, cuts

    def least(self, shards: int, low: int, high: int, cut_any: bool) -> int:
        """The smallest capacity from ``low`` to ``high`` that succeeds; ``high`` must."""
        while low < high:
            middle = (low + high) // 2
            if self.fill(middle, shards, cut_any)[0]:
                high = middle
            else:
                low = middle + 1
        return low


def _summary(groups: DataFrame, stretches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, bool]]:
    """Sizes in cells of 2 to ``shift`` places inside stretches (from, to, shift), fewer than there are shards."""
    place = F.col("place")
    number, cell, inside = F.lit(None), F.lit(None), F.lit(False)
    for i, (start, end, shift) in enumerate(stretches):
        here = (place >= start) & (place < end)
        number = F.when(here, F.lit(i)).otherwise(number)
        cell = F.when(here, F.shiftright(place - F.lit(start), shift)).otherwise(cell)
        inside = inside | here
    found = (
        groups.filter(inside)
        .groupBy(number.cast("int").alias("i"), cell.cast("long").alias("cell"))
        .agg(F.sum("size").cast("long").alias("size"), F.min("place").alias("low"), F.max("place").alias("high"))
        .collect()
    )
    rows = []
    for r in found:
        start, end, shift = stretches[r.i]
        first = start + (r.cell << shift)
        if r.low == r.high:
            rows.append((r.low, r.low + 1, r.size, True))
        else:
            rows.append((first, min(end, first + (1 << shift)), r.size, False))
    return rows


def cuts(groups: DataFrame, shards: int) -> tuple[list[int], list[int]]:
    """(places of groups with a shard of their own, first places of the shards after the first of the others).

    groups: (place, size), a row for each group.
    """
    total = groups.agg(F.sum("size")).first()[0] or 0
    if not total:
        return [], []
    # Fewer than ``shards`` groups can exceed an even share of what remains after the larger ones.
    largest = groups.orderBy(F.desc("size"), "place").limit(shards).collect()
    alone, rest = [], int(total)
    for row in largest[: shards - 1]:
        if row.size * (shards - len(alone)) <= rest or rest == row.size:
            break
        alone.append(row.place)
        rest -= int(row.size)
    left = shards - len(alone)
    groups = groups.filter(~F.col("place").isin(alone)) if alone else groups
    biggest = int(largest[len(alone)].size) if len(alone) < len(largest) else 1
    cells = _Cells(_summary(groups, [(0, 1 << ORDER_BITS, ORDER_BITS - FIRST_CELLS)]))
    while True:
        least = max(biggest, -(-rest // left))
        low = cells.least(left, least, rest, True)
        high = cells.least(left, low, rest, False) if cells.fill(rest, left, False)[0] else rest
        best, worst = cells.fill(high, left, True)[1], cells.fill(low, left, False)[1]
        # The j-th cut of any capacity in question lies between two cells; if they aren't all groups, cut them finer.
        stretches: list[list[int]] = []
        for j in range(left - 1):
            ends = (x[j][0] if j < len(x) else len(cells.rows) - 1 for x in (worst, best))
            first, last = sorted(ends)
            if all(cells.rows[k][3] for k in range(first, last + 1)):
                continue
            if stretches and first <= stretches[-1][1]:
                stretches[-1][1] = max(last, stretches[-1][1])
            else:
                stretches.append([first, last])
        if not stretches:
            break
        wanted, dropped = [], set()
        for first, last in stretches:
            own = [cells.rows[k] for k in range(first, last + 1)]
            start, end = own[0][0], own[-1][1]
            narrowest = min(r[1] - r[0] for r in own if not r[3])
            dropped.update(range(first, last + 1))
            wanted.append((start, end, max(0, min((end - start - 1).bit_length() - FINER_CELLS, narrowest.bit_length() - 3))))
        cells = _Cells([r for k, r in enumerate(cells.rows) if k not in dropped] + _summary(groups, wanted))
    capacity = cells.least(left, least, rest, False)
    return alone, [cells.rows[k][0] for k, _ in cells.fill(capacity, left, False)[1]]


def shards_by_bytes(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, place, shard, slot): equal texts stay together, and sizes are as equal as that allows."""
    stage = Stage(docs.sparkSession)
    rows = stage.keep(_measured(docs, id_col, text_col))
    groups = stage.keep(rows.groupBy("place").agg(F.sum("size").alias("size")))
    alone, starts = cuts(groups, shards)
    place = F.col("place")
    shard = F.lit(0)
    for start in starts:
        shard = shard + (place >= F.lit(start)).cast("int")
    for i, own in enumerate(alone):
        shard = F.when(place == F.lit(own), F.lit(shards - 1 - i)).otherwise(shard)
    return numbered(rows.withColumn("shard", shard.cast("int")), "shard", shards)


def numbered(rows: DataFrame, shard_col: str, shards: int) -> DataFrame:
    """``rows`` with ``slot``, counted from 0 in each shard in an order that follows from id and text."""
    mixed = F.xxhash64("id", "place")
    sub = F.pmod(mixed, F.greatest(F.lit(1), F.ceil(F.lit(rows.count() / (shards * SUBCELL_ROWS)))).cast("long"))
    dealt = rows.withColumn("_sub", sub)
    before = W.partitionBy(shard_col).orderBy("_sub").rowsBetween(W.unboundedPreceding, -1)
    offsets = dealt.groupBy(shard_col, "_sub").agg(F.count(F.lit(1)).alias("_n"))
    offsets = offsets.select(shard_col, "_sub", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy(shard_col, "_sub").orderBy(mixed, "id", "place")
    return (
        dealt.withColumn("_row", F.row_number().over(inside))
        .join(offsets, [shard_col, "_sub"])
        .withColumn("slot", (F.col("_row") + F.col("_before") - 1).cast("long"))
        .drop("_sub", "_row", "_before")
    )
