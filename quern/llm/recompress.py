"""Exact removal of repeated word windows by recompression.

Every text is parsed by the same rounds: runs of equal symbols get a name, then symbols are parted in left and right
ones by a bit of their name, and each left symbol followed by a right one becomes a pair with a name. A name is a hash
of what it stands for, so all tasks of the Spark jobs give equal content equal names without asking one another. With
each symbol goes its reach: the words that alone decide that the symbol is there. Where two windows are equal, symbols
whose reach lies inside the window are equal too, wherever the windows are.

So each window is filed under one such symbol, the one with the smallest hash on the highest level that has any.
Neighbouring windows share their symbol, and are filed as one block. Equal windows lie under equal names. One shuffle
brings the blocks of a name together: a block that was already met earlier is a repeat as a whole. Where different
blocks share a name, their first occurrences are compared window by window in a second, small step, over the words.

Blocks met twice in one strip of words are settled there. Where a strip has different blocks of one name, one of them
stands for the name; the others go on by name and content, known to need the second step. So a line that very many
documents share sends a row for each strip to the task of its name. Names and block contents are compared by 128 bits
together.

Defined results: a null text has no words. A text shorter than a window keeps all. A null id keeps its text whole and
gives nothing to others. Repeated rows (equal id and text) are treated alike. Different texts of one id are one document:
they follow one another in the order of their hashes, and no window reaches from one into the next. Copies of a text
under other ids lose all words if they have a window's length. An empty table gives no rows. Columns other than those
named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.shared import Stage, byte_words, native_words

#: Levels of symbols; the reach of higher ones seldom fits in a window of 20 words.
LEVELS = 2
#: Words that are parsed at a time.
STRIP = 200_000

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODDER = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x5851F42D4C957F2D
_SHIFT = np.uint64(32)

#: route: what rows are dealt by. windows: how many; 0 for a settled span, whose block is where it stops. known: whether
#: the name has other blocks already.
BLOCKS = "route long, name long, block long, id long, start int, windows int, known boolean"
SPANS = "name long, id long, start int, stop int"


def _mix(*parts: np.ndarray | int) -> np.ndarray:
    """A 64-bit hash of equal rows of numbers."""
    out = np.uint64(0)
    for part in parts:
        out = (out ^ np.asarray(part).astype(np.uint64)) * _ODD
        out = (out ^ (out >> _SHIFT)) * _ODDER
    return out ^ (out >> np.uint64(29))


class Contents:
    """Hashes of any stretches of a row of word hashes, from sums of their multiples."""

    def __init__(self, words: np.ndarray) -> None:
        size = len(words) + 1
        powers = np.full(size, _BASE, np.uint64)
        powers[0] = 1
        inverse = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        self._back = np.cumprod(inverse)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * np.cumprod(powers)[:-1])])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mix((self._sums[stop] - self._sums[start]) * self._back[start], stop - start)


def _levels(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(name, reach from, reach to) of the symbols of each level. first, last: whether a word begins or ends a text.

    A reach that goes beyond the text is marked by -1 or by the number of all words plus one.
    """
    outside = len(words) + 1
    name, low, high = words, np.arange(len(words)), np.arange(1, len(words) + 1)
    levels = [(name, low, high)]
    for level in range(LEVELS):
        # Runs. That a run ends where it ends is decided by the symbols beside it.
        new = first.copy()
        new[1:] |= name[1:] != name[:-1]
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(name))
        times = stop - at
        low_of = np.where(first[at], -1, low[np.maximum(at - 1, 0)])
        high_of = np.where(last[stop - 1], outside, high[np.minimum(stop, len(name) - 1)])
        name = np.where(times > 1, _mix(name[at], times, 3 * level + 1), name[at])
        first, last, low, high = first[at], last[stop - 1], low_of, high_of
        # Pairs. Which symbols are left ones is a bit of their names, another one each round.
        left = (_mix(name, 3 * level + 2) & np.uint64(1)).astype(bool)
        joins = np.zeros(len(name), bool)
        joins[:-1] = left[:-1] & ~left[1:] & ~last[:-1]
        joined = np.zeros(len(name), bool)
        joined[1:] = joins[:-1]
        after, before = np.minimum(np.arange(len(name)) + 1, len(name) - 1), np.maximum(np.arange(len(name)) - 1, 0)
        # A left symbol alone depends on the one after it, a right one alone on the one before.
        high_of = np.where(left, np.where(last, outside, high[after]), high)
        low_of = np.where(left, low, np.where(first, -1, low[before]))
        name = np.where(joins, _mix(name, name[after], 3 * level + 3), name)
        # A pair reaches as far as its two symbols do.
        low, high = np.where(joins, low, low_of), np.where(joins, high[after], high_of)
        last = np.where(joins, last[after], last)
        kept = ~joined
        name, low, high, first, last = name[kept], low[kept], high[kept], first[kept], last[kept]
        levels.append((name, low, high))
    return levels


def _smallest(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The leftmost place of the smallest of ``order`` between ``low`` and ``high``, both counted in."""
    best = [np.arange(len(order))]
    width = int((high - low).max()) + 1 if len(low) else 1
    while 2 << (len(best) - 1) <= width:
        step, now = 1 << (len(best) - 1), best[-1]
        other = now[np.minimum(np.arange(len(order)) + step, len(order) - 1)]
        best.append(np.where(order[now] <= order[other], now, other))
    power = np.frexp((high - low + 1).astype(np.float64))[1] - 1
    table = np.stack(best)
    a, b = table[power, low], table[power, high + 1 - (1 << power)]
    return np.where(order[a] <= order[b], a, b)


def filed(words: np.ndarray, cuts: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """(name, block, first window, number of windows) of each block of windows that share a symbol.

    cuts: where each text begins, and the number of all words.
    """
    size = len(words)
    text = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    first, last = np.zeros(size, bool), np.zeros(size, bool)
    first[cuts[:-1][np.diff(cuts) > 0]] = True
    last[cuts[1:][np.diff(cuts) > 0] - 1] = True
    places = np.flatnonzero(np.arange(size) + window <= cuts[1:][text]) if size else np.empty(0, np.int64)
    if not len(places):
        return tuple(np.empty(0, np.int64) for _ in range(4))
    low_of, high_of, symbol = (np.empty(len(places), np.int64) for _ in range(3))
    open_ = np.arange(len(places))
    offset = 0
    levels = _levels(words, first, last)
    for level in range(len(levels) - 1, -1, -1):
        name, low, high = levels[level]
        fits = np.flatnonzero((low >= 0) & (high <= size) & (high - low <= window))
        name, low, high = name[fits], low[fits], high[fits]
        here = places[open_]
        a, b = np.searchsorted(low, here, "left"), np.searchsorted(high, here + window, "right") - 1
        some = a <= b
        if some.any():
            chosen = _smallest(_mix(name, 99), a[some], b[some])
            done = open_[some]
            low_of[done], high_of[done], symbol[done] = low[chosen], high[chosen], chosen + offset
            open_ = open_[~some]
        offset += len(fits)
        if not len(open_):
            break
    new = np.ones(len(places), bool)
    new[1:] = (symbol[1:] != symbol[:-1]) | (places[1:] != places[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(places)))
    start = places[at]
    contents = Contents(words)
    name = contents.of(low_of[at], high_of[at])
    block = _mix(contents.of(start, start + count - 1 + window), start - low_of[at])
    return name.view(np.int64), block.view(np.int64), start, count


def _strips(batch: pa.RecordBatch, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(word hashes, cuts, id of each text, place of its first word) of a bounded number of words at a time.

    A long text is cut in strips that share all words but one of a window, so that each window lies in one strip.
    """
    held: list[np.ndarray] = []
    ids: list[int] = []
    places: list[int] = []
    size = 0

    def out():
        cuts = np.concatenate([[0], np.cumsum([len(h) for h in held])])
        return np.concatenate(held), cuts, np.array(ids, np.int64), np.array(places, np.int64)

    for own, text, begin in zip(*batch.columns, strict=True):
        words = byte_words(text.as_py())
        if len(words) < window:
            continue
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        for start in range(0, len(hashes) - window + 1, STRIP):
            held.append(hashes[start : start + STRIP + window - 1])
            ids.append(own.as_py())
            places.append(begin.as_py() + start)
            size += len(held[-1])
            if size >= STRIP:
                yield out()
                held, ids, places, size = [], [], [], 0
    if held:
        yield out()


def _settled(name, block, own, start, count) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order by name, block, id and start; and whether each is a repeat of the first of its block."""
    order = np.lexsort([start, own, block, name])
    n, b, o, s = name[order], block[order], own[order], start[order]
    new = np.ones(len(order), bool)
    new[1:] = (n[1:] != n[:-1]) | (b[1:] != b[:-1])
    head = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order, (o != o[head]) | (s != s[head])


def _merged(own: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of each id that touch or overlap, as one."""
    order = np.lexsort([start, own])
    own, start, stop = own[order], start[order], stop[order]
    if not len(own):
        return own, start, stop
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (start[1:] > stop[:-1])
    at = np.flatnonzero(new)
    return own[at], start[at], stop[np.append(at[1:], len(own)) - 1]


def _rows(name, block, own, start, count, window: int) -> pa.RecordBatch:
    """First blocks of a strip, as ``BLOCKS`` describes, and its repeats as settled spans."""
    order, repeat = _settled(name, block, own, start, count)
    firsts, again = order[~repeat], order[repeat]
    n, b = name[firsts], block[firsts]
    other = np.zeros(len(n), bool)  # not the first block of its name
    other[1:] = n[1:] == n[:-1]
    known = other.copy()
    known[:-1] |= other[1:]
    ids, begin, stop = _merged(own[again], start[again], start[again] + count[again] - 1 + window)
    nothing = np.zeros(len(ids), np.int64)
    spread = _mix(ids, begin).view(np.int64)
    columns = [
        np.concatenate([np.where(other, _mix(n, b).view(np.int64), n), spread]),
        np.concatenate([n, spread]),
        np.concatenate([b, stop]),
        np.concatenate([own[firsts], ids]),
        np.concatenate([start[firsts], begin]).astype(np.int32),
        np.concatenate([count[firsts], nothing]).astype(np.int32),
        np.concatenate([known, nothing.astype(bool)]),
    ]
    return pa.record_batch([pa.array(c) for c in columns], [f.split()[0] for f in BLOCKS.split(", ")])


def blocks(docs: DataFrame, window: int) -> DataFrame:
    """The blocks of every text (id long, text, begin int), as ``_rows`` describes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words, cuts, ids, places in _strips(batch, window):
                name, block, start, count = filed(words, cuts, window)
                text = np.searchsorted(cuts, start, "right") - 1
                yield _rows(name, block, ids[text], start - cuts[text] + places[text], count, window)

    return docs.mapInArrow(run, BLOCKS)


def _told(*rows: tuple[np.ndarray, ...]) -> pa.RecordBatch | None:
    """Rows of ``SPANS`` from tuples of name (or none), id, start and stop."""
    batches = [
        pa.record_batch(
            [
                pa.nulls(len(own), pa.int64()) if name is None else pa.array(name),
                pa.array(own),
                pa.array(start.astype(np.int32)),
                pa.array(stop.astype(np.int32)),
            ],
            ["name", "id", "start", "stop"],
        )
        for name, own, start, stop in rows
        if len(own)
    ]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if batches else None


def repeats(rows: DataFrame, window: int, route: str = "route") -> DataFrame:
    """Spans that repeat an earlier block (name NULL), and first blocks that share their name with other blocks.

    Rows of a name come sorted by block, id and start, so that a few numbers are all that a task carries on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None  # name, block, id and start of the first row of the last block
        head: np.ndarray | None = None  # that row's name, id, start and stop
        known = told = False  # whether its name is known to have other blocks, and whether that was said
        for batch in batches:
            n, b, o, s, c, k = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(6))
            s, c = s.astype(np.int64), c.astype(np.int64)
            gone = c == 0
            settled = (None, o[gone], s[gone], b[gone])
            n, b, o, s, c, k = (x[~gone] for x in (n, b, o, s, c, k))
            if not len(n):
                if out := _told(settled):
                    yield out
                continue
            goes_on = before is not None and before[:2] == (n[0], b[0])
            new = np.ones(len(n), bool)
            new[1:] = (n[1:] != n[:-1]) | (b[1:] != b[:-1])
            new[0] = not goes_on
            place = np.maximum.accumulate(np.where(new, np.arange(len(n)), -1))
            first_id = np.where(place < 0, before[2] if goes_on else 0, o[np.maximum(place, 0)])
            first_start = np.where(place < 0, before[3] if goes_on else 0, s[np.maximum(place, 0)])
            again = (o != first_id) | (s != first_start)
            spans = (None, o[again], s[again], s[again] + c[again] - 1 + window)
            at = np.flatnonzero(new)
            if goes_on:
                known |= bool(k[: at[0] if len(at) else len(k)].any())
            heads = np.stack([n[at], o[at], s[at], s[at] + c[at]], 1).reshape(-1, 4)
            shared = np.logical_or.reduceat(k, at) if len(at) else np.zeros(0, bool)
            if head is not None:
                heads, shared = np.concatenate([head[None], heads]), np.concatenate([[known], shared])
            same = heads[1:, 0] == heads[:-1, 0]
            known = bool(shared[-1])
            shared[1:] |= same
            shared[:-1] |= same
            tell = shared.copy()
            if head is not None:
                tell[0] &= not told
            told = bool(shared[-1])
            asked = heads[tell]
            head, before = heads[-1], (n[-1], b[-1], first_id[-1], first_start[-1])
            if out := _told(settled, spans, tuple(asked.T)):
                yield out

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(parts, route)
        .sortWithinPartitions("name", "block", "id", "start")
        .select("name", "block", "id", "start", "windows", "known")
        .mapInArrow(run, SPANS)
    )


def placed(docs: DataFrame, id_col: str, text_col: str, stage: Stage) -> DataFrame:
    """(id, text, begin): where each text begins among the words of its id.

    That is 0 unless an id has several different texts; these follow one another in the order of their hashes.
    """
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    own = own.withColumn("__hash", F.xxhash64("text"))
    hashes = own.filter("id IS NOT NULL").select("id", "__hash")
    several = hashes.groupBy("id").agg(F.min("__hash").alias("a"), F.max("__hash").alias("b")).filter("a != b").select("id")
    several = stage.keep(several)
    if several.isEmpty():
        return own.select("id", "text", F.lit(0).alias("begin"))
    texts = own.join(several, "id").groupBy("id", "__hash").agg(F.max(F.size(native_words(F.col("text")))).alias("words"))
    before = W.partitionBy("id").orderBy("__hash").rowsBetween(W.unboundedPreceding, -1)
    begins = stage.keep(texts.select("id", "__hash", F.coalesce(F.sum("words").over(before), F.lit(0)).cast("int").alias("begin")))
    return own.join(begins, ["id", "__hash"], "left").select("id", "text", F.coalesce("begin", F.lit(0)).alias("begin"))


def _windows(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """Each window from ``start`` to before ``stop`` of the first blocks asked for, as a block of its own."""
    listed = asked.groupBy("id").agg(F.collect_list(F.struct("name", "start", "stop")).alias("asked"))
    joined = docs.join(listed, "id").select("id", "text", "begin", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        size = 0

        def out() -> pa.RecordBatch:
            name, block, own, start = (np.concatenate([f[k] for f in found]) for k in range(4))
            found.clear()
            # Dealt by name and content, so that no name is one task's.
            return _rows(_mix(name, block).view(np.int64), block, own, start, np.ones(len(name), np.int64), window)

        for batch in batches:
            for own, text, begin, want in zip(*batch.columns, strict=True):
                words, begin = byte_words(text.as_py()), begin.as_py()
                hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
                name, start, stop = (c.to_numpy() for c in want.values.flatten())
                mine = (start >= begin) & (start < begin + len(words))
                name, start, stop = name[mine], start[mine].astype(np.int64) - begin, stop[mine].astype(np.int64) - begin
                count = stop - start
                places = np.repeat(start - np.cumsum(count) + count, count) + np.arange(count.sum())
                block = Contents(hashes).of(places, places + window).view(np.int64)
                found.append((np.repeat(name, count), block, np.full(len(places), own.as_py()), places + begin))
                size += len(places)
                if size >= STRIP:
                    yield out()
                    size = 0
            if found:
                yield out()
                size = 0

    return joined.mapInArrow(run, BLOCKS)


def repeated_spans(docs: DataFrame, window: int, stage: Stage) -> DataFrame:
    """(id, spans) of ``placed`` texts: the words, as an array of (start, stop), that windows met earlier cover."""
    own = docs.filter("id IS NOT NULL")
    first = stage.keep(repeats(blocks(own, window), window))
    second = stage.keep(repeats(_windows(own, first.filter("name IS NOT NULL"), window), window))
    spans = first.unionAll(second).filter("name IS NULL")
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def kept_words(
    docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", make=None,
    schema: str = "n_words long, n_removed long, kept string",
) -> DataFrame:
    """(id, n_words, n_removed, kept): the text without words of windows that also start earlier.

    Earlier is a smaller id, or the same id and an earlier place. ``make(words, keep)`` may return other columns
    of ``schema``, given a text's words and which of them stay.
    """
    stage = Stage(docs.sparkSession)
    own = placed(docs, id_col, text_col, stage)
    spans = repeated_spans(own, window, stage)
    joined = own.join(spans, "id", "left").select("id", "text", "spans", "begin")
    fields = [f.strip().split()[0] for f in schema.split(", ")]

    def plain(words: list[bytes], keep: np.ndarray):
        return len(words), int(len(words) - keep.sum()), b" ".join(w for w, k in zip(words, keep, strict=True) if k).decode()

    build = make or plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for text, found, begin in zip(*part.columns[1:], strict=True):
                    words = byte_words(text.as_py())
                    keep = np.ones(len(words), bool)
                    if found.is_valid:
                        # Spans of another text of this id end up empty.
                        start, stop = (np.clip(c.to_numpy() - begin.as_py(), 0, len(words)) for c in found.values.flatten())
                        edges = np.zeros(len(words) + 1, np.int64)
                        np.add.at(edges, start, 1)
                        np.add.at(edges, stop, -1)
                        keep = np.cumsum(edges)[:-1] == 0
                    rows.append(build(words, keep))
                columns = zip(*rows, strict=True)
                yield pa.record_batch([part.column(0), *map(pa.array, columns)], ["id", *fields])

    return joined.mapInArrow(run, f"id long, {schema}")


def digests(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_sha256)."""

    def make(words: list[bytes], keep: np.ndarray):
        if keep.all():
            kept = words
        else:
            kept = [words[i] for i in np.flatnonzero(keep)]
        return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    return kept_words(docs, window, id_col, text_col, make, "n_words long, n_removed long, kept_sha256 string")
