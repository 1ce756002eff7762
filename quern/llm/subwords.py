"""Hashed word and character n-gram features of whole texts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of more bytes are hashed one by one.
LONG = 48
#: Words whose features a worker remembers before it starts anew.
REMEMBERED = 200_000


class Subwords:
    """The buckets of a word's own name and of its character n-grams, and those of word pairs.

    A pair of equal words falls into one bucket whatever the word is: its second member is written as a reference
    to the first.
    """

    def __init__(self, buckets: int, shortest: int = 3, longest: int = 4, pairs: bool = True) -> None:
        self.buckets, self.shortest, self.longest, self.pairs = buckets, shortest, longest, pairs
        self._seen: dict[str, np.ndarray] = {}

    def of_word(self, word: str) -> np.ndarray:
        """The word's own bucket first, then those of its n-grams between marks for its ends."""
        own = self._seen.get(word)
        if own is None:
            if len(self._seen) > REMEMBERED:
                self._seen.clear()
            marked = f"\x02{word}\x03"
            grams = [marked]
            for size in range(self.shortest, self.longest + 1):
                grams += [marked[i : i + size] for i in range(len(marked) - size + 1)]
            own = np.array([crc32(g.encode()) % self.buckets for g in grams], np.int32)
            self._seen[word] = own
        return own

    def pair(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Buckets of pairs given the own buckets of their words."""
        mixed = (first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        return np.where(first == second, 1, (mixed >> np.uint64(32)) % np.uint64(self.buckets)).astype(np.int32)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of a whole text and how often each occurs."""
        words = (text or "").split()
        if not words:
            return np.empty(0, np.int32), np.empty(0, np.float32)
        found = Counter(words)
        own = [self.of_word(word) for word in found]
        places = [np.concatenate(own)]
        times = [np.repeat(np.fromiter(found.values(), np.float32, len(found)), [len(x) for x in own])]
        if self.pairs:
            names = {word: x[0] for word, x in zip(found, own, strict=True)}
            row = np.fromiter(map(names.__getitem__, words), np.int32, len(words))
            places.append(self.pair(row[:-1], row[1:]))
            times.append(np.ones(len(words) - 1, np.float32))
        place, inverse = np.unique(np.concatenate(places), return_inverse=True)
        return place, np.bincount(inverse, np.concatenate(times)).astype(np.float32)


def _table() -> np.ndarray:
    """What CRC-32 makes of each byte: eight shifts of the reflected polynomial."""
    found = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        found = (found >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (found & np.uint32(1)))
    return found


_TABLE = _table()


def crc32_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The checksums of short stretches of bytes, all advanced together by one byte a step."""
    found = np.full(len(start), 0xFFFFFFFF, np.uint32)
    size = end - start
    for step in range(int(size.max(initial=0))):
        live = slice(None) if size.min() > step else np.flatnonzero(size > step)
        now = found[live]
        found[live] = _TABLE[(now ^ data[start[live] + step]) & np.uint32(255)] ^ (now >> np.uint32(8))
    return found ^ np.uint32(0xFFFFFFFF)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and how many each text has; divided at white space as by ``split``."""
    parts = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    flat, cuts = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), np.diff(before[cuts - cuts[0]])


class Bags:
    """Features of many texts at once: of each distinct word, and of the words and pairs of each text."""

    def __init__(self, subwords: Subwords, texts: pa.Array) -> None:
        self.subwords = subwords
        words, self.sizes = words_of(texts)
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.text = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self._mark(coded.dictionary.cast(pa.binary()))
        size = self.last + 1 - self.first
        own = np.empty(len(size), np.uint32)
        short = size <= LONG
        own[short] = crc32_of(self.data, self.first[short], self.last[short] + 1)
        for k in np.flatnonzero(~short):
            own[k] = crc32(self.data[self.first[k] : self.last[k] + 1])
        self.names = (own % np.uint32(subwords.buckets)).astype(np.int32)

    def _mark(self, words: pa.Array) -> None:
        """The bytes of the distinct words, each between marks for its ends, and the places of these marks."""
        cuts = np.frombuffer(words.buffers()[1], np.int32)[words.offset :][: len(words) + 1].astype(np.int64)
        raw = np.frombuffer(words.buffers()[2] or b"", np.uint8)[cuts[0] : cuts[-1]]
        marks = 2 * np.arange(len(words))
        self.first, self.last = cuts[:-1] - cuts[0] + marks, cuts[1:] - cuts[0] + marks + 1
        self.data = np.empty(len(raw) + 2 * len(words), np.uint8)
        inner = np.ones(len(self.data), bool)
        inner[self.first] = inner[self.last] = False
        self.data[inner], self.data[self.first], self.data[self.last] = raw, 2, 3

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the character n-grams of the distinct words, and the word that each belongs to."""
        data, first = self.data, self.first
        begins = np.flatnonzero((data & 0xC0) != 0x80)
        word = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(data))))[begins]
        ends = np.append(begins, len(data))
        buckets, owners = [], []
        for size in range(self.subwords.shortest, self.subwords.longest + 1):
            at = np.flatnonzero(word[: len(word) - size + 1] == word[size - 1 :])
            buckets.append(crc32_of(data, begins[at], ends[at + size]) % np.uint32(self.subwords.buckets))
            owners.append(word[at])
        return np.concatenate(buckets), np.concatenate(owners)

    def sums(self, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the sum of its features' weights and the number of its features."""
        bucket, owner = self.grams()
        many = len(self.names)
        of_word = weights[self.names] + np.bincount(owner, weights[bucket], many)
        size = 1 + np.bincount(owner, minlength=many)
        texts = len(self.sizes)
        total = np.bincount(self.text, of_word[self.codes], texts)
        count = np.bincount(self.text, size[self.codes], texts)
        if self.subwords.pairs and len(self.codes):
            same = np.flatnonzero(self.text[:-1] == self.text[1:])
            row = self.names[self.codes]
            paired = weights[self.subwords.pair(row[same], row[same + 1])]
            total += np.bincount(self.text[same], paired, texts)
            count += np.bincount(self.text[same], minlength=texts)
        return total, count


def stretches(texts: pa.Array, most: int) -> Iterator[pa.Array]:
    """The texts in order, a stretch of at most ``most`` bytes at a time, or a single longer text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        end = max(start + 1, int(np.searchsorted(size, (size[start - 1] if start else 0) + most, "right")))
        yield texts.slice(start, end - start)
        start = end


def labelled(labels: DataFrame, label_col: str, held_out: str, most: int, id_col: str) -> DataFrame:
    """(_id, _label) of at most ``most`` rows labelled 0 or 1, those with the smallest hash of their id.

    held_out: SQL condition on the id; rows it holds for are left out.
    """
    known = labels.filter(f"{id_col} IS NOT NULL AND NOT ({held_out})")
    known = known.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    return known.filter("_label IN (0, 1)").orderBy(F.xxhash64("_id", F.lit("sample")), "_id", "_label").limit(most)


def featured(rows: DataFrame, text_col: str, others: list[str], counts) -> pa.Table:
    """What ``counts`` makes of the texts of a bounded sample, with its other columns, on the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(text.as_py()) for text in batch.column(0)]
            columns = [pa.array([x[k] for x in found], kind) for k, kind in ((0, pa.list_(pa.int32())), (1, pa.list_(pa.float32())))]
            yield pa.record_batch([*batch.columns[1:], *columns], [*others, "place", "times"])

    chosen = rows.select(text_col, *[F.col(c).cast("int").alias(c) for c in others])
    schema = ", ".join([*(f"{c} int" for c in others), "place array<int>, times array<float>"])
    return chosen.mapInArrow(run, schema).toArrow()


def sparse_rows(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each row of what ``featured`` returned, without copying them."""
    rows = []
    for batch in table.to_batches():
        place, times = batch.column("place"), batch.column("times")
        cuts = place.offsets.to_numpy()
        p, t = place.values.to_numpy(), times.values.to_numpy()
        rows += [(p[a:b], t[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return rows



def in_order(table: pa.Table, marks: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Rows and their marks in an order that follows from what they hold, not from how they were partitioned."""
    rows = sparse_rows(table)
    wanted = np.stack([table.column(c).to_numpy() for c in marks], 1)
    sums = [np.array([float(x[k].sum()) if len(x[k]) else 0.0 for x in rows]) for k in (0, 1)]
    order = np.lexsort([*wanted.T, *sums])
    return [rows[i] for i in order], wanted[order]
