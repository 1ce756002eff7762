"""Repair of conversations: the cheapest edits after which roles alternate, found by streaming.

Rows are dealt out by conversation once. Inside a partition they are sorted by Spark (which spills) three times:

* by conversation and content, to mark rows that repeat an earlier one;
* backwards by turn. ``mapInArrow`` carries the costs of the best repair of all that follows, one for each state of the
  wanted pattern, from batch to batch, and notes for each row one byte: the best edit in each of the four states;
* forwards by turn. A second ``mapInArrow`` follows these bytes from the first state on and carries the state, the counts
  and a running digest.

Neither of the two holds rows of earlier batches: the backpointers of a conversation of any length lie, a byte a row, in
Spark's sorted spill files, and a lost executor repeats its partition from the shuffle. What grows with a conversation in
memory is only its list of edits, a byte each, when a summary asks for it as one cell.

Wanted are role initials ``(s?(ua)+)?``. Edits and costs: Keep 0; Rerole to user or assistant 1; Delete 2, the only
choice for blank and repeated rows; Insert an empty text of user or assistant 5. A truncated row that stays adds 5. Of the
cheapest lists of edits the one whose initials are least in ASCII is taken; it also fixes the roles.

Defined results: a null role or text is one space. Null turns come first; rows of one turn are ordered by role, then text.
A null conversation id is a conversation like any other. A conversation without present rows has zeros, no edits and no
rows. An empty table gives no rows. Columns other than those named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.llm.lines import OUTER

#: States of the wanted pattern: nothing yet, behind the system row, behind a user, behind an assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Where a kept row of each initial leads from each state; None where the pattern forbids it.
NEXT = {"s": (SYSTEM, None, None, None), "u": (USER, USER, None, USER), "a": (None, None, ASSISTANT, None), "": (None,) * 4}
#: The role that an inserted or reroled row gets in each state.
ROLE = ("user", "user", "assistant", "user")
AFTER = (USER, USER, ASSISTANT, USER)
EDITS = "DIKR"  # in ASCII order
KEEP, REROLE, DELETE, INSERT, CUT = 0, 1, 2, 5, 5
#: Costs of ending in each state: in the last two steps only insertions help.
END = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 40

#: First faults; their order is that of the codes.
SOUND, BLANK, REPEATED, TRUNCATED = range(4)
INITIALS = "sua"  # a role of any other initial has the code behind them
LEGAL = {(0, 1), (1, 2), (2, 1)}


def present(conversations: DataFrame) -> DataFrame:
    """Rows as they are: nulls as one space, each once."""
    return conversations.select(
        F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.lit(True).alias("here"),
    )


def faults(rows: DataFrame) -> DataFrame:
    """Rows dealt out by conversation, with ``shape``: 4 times the initial's code plus that of the first fault.

    ``nth`` numbers the rows of equal content, which tells equal rows of one turn apart.
    """
    bare = F.rtrim(F.col("text"), F.lit(OUTER))
    dealt = rows.withColumns({"__r": F.xxhash64("role", "text"), "__s": F.xxhash64(F.lit("second"), "text", "role")}).repartition("conv")
    # Dealt out by conversation already: this sorts, but shuffles nothing.
    nth = F.row_number().over(W.partitionBy("conv", "here", "__r", "__s").orderBy(F.col("turn").asc_nulls_first()))
    fault = (
        F.when(bare == "", BLANK).when(F.col("nth") > 1, REPEATED).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND)
        .otherwise(TRUNCATED)
    )
    initial = F.coalesce(*[F.when(F.left("role", F.lit(1)) == c, k) for k, c in enumerate(INITIALS)], F.lit(len(INITIALS)))
    return dealt.withColumn("nth", nth).withColumn("shape", (initial * 4 + fault).cast("int")).drop("__r", "__s")


def best(costs: tuple[int, ...], shape: int) -> tuple[tuple[int, ...], int]:
    """Costs of the best repair from a row on, by state, given those from the row after it on, and the edits to make.

    The edits are two bits for each state. Insertions lead to another state before the same row, where two or fewer of
    them in a row are of use.
    """
    initial, fault = divmod(shape, 4)
    follow = NEXT[INITIALS[initial] if initial < 3 else ""]
    cut = CUT if fault == TRUNCATED else 0
    bound = fault in (BLANK, REPEATED)
    options = []
    for state in range(4):
        kept = NEVER if bound or follow[state] is None else costs[follow[state]] + KEEP + cut
        rerole = NEVER if bound else costs[AFTER[state]] + REROLE + cut
        options.append([costs[state] + DELETE, NEVER, kept, rerole])
    found = [min(x) for x in options]
    for _ in range(3):
        found = [min(found[s], found[AFTER[s]] + INSERT) for s in range(4)]
    edits = 0
    for s in range(4):
        options[s][1] = found[AFTER[s]] + INSERT
        edits |= options[s].index(found[s]) << (2 * s)
    return tuple(found), edits


class Backwards:
    """The costs carried from row to row, backwards, without their common part, and each step remembered.

    Costs of two states differ by a bounded amount, so only few vectors of differences exist.
    """

    def __init__(self) -> None:
        self.known: dict[tuple[tuple[int, ...], int], tuple[tuple[int, ...], int]] = {}

    def step(self, costs: tuple[int, ...], shape: int) -> tuple[tuple[int, ...], int]:
        found = self.known.get((costs, shape))
        if found is None:
            new, edits = best(costs, shape)
            low = min(new)
            found = self.known[costs, shape] = tuple(c - low for c in new), edits
        return found


def with_edits(rows: DataFrame) -> DataFrame:
    """Rows of ``faults`` sorted forwards, with ``edits``: the byte of best edits by state."""
    content = ("role", "text", "nth")
    back = rows.sortWithinPartitions("conv", F.col("turn").desc_nulls_last(), *[F.col(c).desc() for c in content])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steps, conv, costs = Backwards(), None, END
        for batch in batches:
            out = []
            convs, shapes, here = (batch.column(c).to_pylist() for c in ("conv", "shape", "here"))
            for own, shape, there in zip(convs, shapes, here, strict=True):
                if own != conv:
                    conv, costs = own, END
                edits = 0
                if there:
                    costs, edits = steps.step(costs, shape)
                out.append(edits)
            yield pa.record_batch([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "edits"])

    schema = ", ".join([*(f"{n} {t}" for n, t in back.dtypes), "edits int"])
    return back.mapInArrow(run, schema).sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), *content)


class Conversation:
    """What is carried forwards through one conversation."""

    def __init__(self, conv: object) -> None:
        self.conv, self.state, self.cost, self.place = conv, EMPTY, 0, 0
        self.audit, self.digest = bytearray(), hashlib.sha256()
        self.faults, self.illegal, self.before = [0, 0, 0, 0], 0, None
        self.first = self.last = None
        self.turns = 0

    def _written(self, edit: str, role: str, text: str) -> tuple[int, str, str, str]:
        self.digest.update((("\n" if self.place else "") + role + ":" + text).encode())
        self.place += 1
        return self.place - 1, edit, role, text

    def _insert(self) -> tuple[int, str, str, str]:
        role, self.state = ROLE[self.state], AFTER[self.state]
        self.audit += b"I"
        self.cost += INSERT
        return self._written("I", role, "")

    def row(self, turn: int | None, role: str, text: str, shape: int, edits: int) -> list[tuple[int, str, str, str]]:
        """The rows written for one row: those inserted before it, and itself unless it is deleted."""
        initial, fault = divmod(shape, 4)
        self.faults[fault] += 1
        if self.before is not None and (self.before, initial) not in LEGAL:
            self.illegal += 1
        self.before = initial
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        out = []
        while (edit := EDITS[edits >> (2 * self.state) & 3]) == "I":
            out.append(self._insert())
        self.audit += edit.encode()
        if edit == "D":
            self.cost += DELETE
            return out
        if edit == "R":
            role, self.state = ROLE[self.state], AFTER[self.state]
        else:
            self.state = NEXT[INITIALS[initial]][self.state]
        self.cost += (REROLE if edit == "R" else KEEP) + (CUT if fault == TRUNCATED else 0)
        return [*out, self._written(edit, role, text)]

    def end(self) -> list[tuple[int, str, str, str]]:
        out = []
        while self.state not in (EMPTY, ASSISTANT):
            out.append(self._insert())
        return out

    def summary(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        blank, repeated, truncated = self.faults[BLANK:]
        return (
            self.conv, gaps, blank, repeated, truncated, self.illegal, self.cost, self.audit.decode(),
            self.digest.hexdigest(),
        )


def _forwards(rows: DataFrame, schema: str, of_row: Callable, of_end: Callable) -> DataFrame:
    """What ``of_row(conversation, written)`` and ``of_end(conversation, written)`` list, in order."""
    names = ("conv", "turn", "role", "text", "shape", "edits", "here")
    narrow = rows.select(*names)
    target = pa.schema([])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def made(found: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), kind, strict=True)], schema=kind)

        for batch in batches:
            found = []
            for conv, turn, role, text, shape, edits, here in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or now.conv != conv:
                    if now is not None:
                        found += of_end(now, now.end())
                    now = Conversation(conv)
                if here:
                    found += of_row(now, now.row(turn, role, text, shape, edits))
            if found:
                yield made(found, target)
        if now is not None and (found := of_end(now, now.end())):
            yield made(found, target)

    conv = rows.schema["conv"].dataType
    kind = T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(schema).fields])
    target = to_arrow_schema(kind)
    return narrow.mapInArrow(run, kind)


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of the repaired conversations, from place 0 of each."""
    def of(now: Conversation, written: list) -> list[tuple]:
        return [(now.conv, *x) for x in written]

    return _forwards(with_edits(faults(rows)), "place long, edit string, role string, text string", of, of)


def summaries(rows: DataFrame) -> DataFrame:
    """One row a conversation: gaps, first faults, illegal neighbours, the cost, list of edits and digest of the repair."""
    kinds = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return _forwards(with_edits(faults(rows)), kinds, lambda now, x: [], lambda now, x: [now.summary()])
