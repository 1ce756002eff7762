"""Byte-level BPE by dynamic programming over byte prefixes.

A sequence of tokens is what the merges make of their bytes exactly if each two neighbours are what the merges make of
those two. So every prefix of a piece has one last token only: the token that ends there, whose remaining prefix ends
in a token it is valid after. These last tokens are all that is stored. Reading them backwards gives the encoding,
appending bytes only adds to them, and after an edit only those from the edit on are found anew. Short pieces share one
table of them, which gets only the prefixes that the last token of a piece depends on.

Defined results: a null text encodes like an empty one, to no tokens. Extra columns are ignored; repeated rows and a
null id keep their rows; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import by_batch


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of lines with a base64 token and a number."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
    return ranks


class Vocabulary:
    """Ranks of byte tokens, with what is known of which tokens may follow which."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        self._never = 1 + max(ranks.values())
        self._last_merge: dict[bytes, tuple[bytes, bytes] | None] = {}
        self._edges: dict[tuple[bytes, bool], list[tuple[bytes, int]]] = {}
        self._follows: dict[tuple[bytes, bytes], bool] = {}
        # Tokens that the merges make of their own bytes, and how long those are that end in given three bytes.
        self._made = {token for token in ranks if len(token) == 1 or self.last_merge(token)}
        lengths: dict[bytes, set[int]] = {}
        for token in self._made:
            if len(token) > 2:
                own = lengths.setdefault(token[-3:], {1} | ({2} if token[-2:] in self._made else set()))
                own.add(len(token))
        self._lengths = {end: tuple(sorted(own)) for end, own in lengths.items()}
        self._longest_first = {end: own[::-1] for end, own in self._lengths.items()}

    def last_merge(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two parts of which the merges make a token last; None if they don't make it of its own bytes."""
        if token not in self._last_merge:
            parts, last = [token[i : i + 1] for i in range(len(token))], None
            while len(parts) > 1:
                ranked = ((self.ranks.get(parts[i] + parts[i + 1], self._never), i) for i in range(len(parts) - 1))
                rank, place = min(ranked)
                if rank == self._never:
                    break
                last = parts[place], parts[place + 1]
                parts[place : place + 2] = [last[0] + last[1]]
            self._last_merge[token] = last if len(parts) == 1 else None
        return self._last_merge[token]

    def _edge(self, token: bytes, right: bool) -> list[tuple[bytes, int]]:
        """The parts that lie at one end of a token while it is made, each with the rank of the next."""
        if (token, right) not in self._edges:
            parts, part = [(token, self._never)], token
            while len(part) > 1:
                rank, part = self.ranks[part], self.last_merge(part)[right]
                parts.append((part, rank))
            self._edges[token, right] = parts[::-1]
        return self._edges[token, right]

    def follows(self, first: bytes, second: bytes) -> bool:
        """Whether the merges make these two tokens of their joined bytes.

        While both are made, in order of rank, the parts that meet at the border change. They stay two tokens if no
        two parts that meet would themselves be merged before either changes; of equal ranks the left one is first.
        """
        pair = first, second
        if pair not in self._follows:
            if len(self._follows) > 1_000_000:
                self._follows.clear()
            left, right, i, j, apart = self._edge(first, True), self._edge(second, False), 0, 0, True
            while apart:
                (a, until_a), (b, until_b) = left[i], right[j]
                across = self.ranks.get(a + b, self._never)
                apart = across >= until_a or across > until_b or across == self._never
                if until_a == until_b == self._never:
                    break
                if until_a <= until_b:
                    i += 1
                else:
                    j += 1
            self._follows[pair] = apart
        return self._follows[pair]

    def last_token(self, piece: bytes, end: int, before) -> bytes:
        """The last token of the prefix of ``piece`` that ends at ``end``; ``before(n)`` gives that of a shorter one."""
        made, known = self._made, self._follows
        for length in self._lengths.get(piece[end - 3 : end], (1, 2)) if end > 2 else (1, 2):
            if length > end:
                break
            token = piece[end - length : end]
            if token not in made:
                continue
            if length == end:
                return token
            first = before(end - length)
            follows = known.get((first, token))
            if follows or follows is None and self.follows(first, token):
                return token
        raise ValueError("the vocabulary lacks a byte of the text")

    def last_token_by_need(self, piece: bytes, last: dict[bytes, bytes]) -> bytes:
        """The last token of ``piece``, longest candidates first; ``last`` gets it and those of the prefixes it takes."""
        made, known, size = self._made, self._follows, len(piece)
        for length in self._longest_first.get(piece[-3:], (2, 1)) if size > 2 else (2, 1):
            if length > size:
                continue
            token = piece[size - length :]
            if token not in made:
                continue
            if length == size:
                break
            before = piece[: size - length]
            first = last.get(before) or self.last_token_by_need(before, last)
            follows = known.get((first, token))
            if follows or follows is None and self.follows(first, token):
                break
        else:
            raise ValueError("the vocabulary lacks a byte of the text")
        last[piece] = token
        return token

    def last_lengths(self, piece: bytes, lengths: list[int]) -> list[int]:
        """Go on with ``lengths``, the length of the last token of each prefix of ``piece`` known so far."""

        def before(end: int) -> bytes:
            return piece[end - lengths[end - 1] : end]

        for end in range(len(lengths) + 1, len(piece) + 1):
            lengths.append(len(self.last_token(piece, end, before)))
        return lengths

    def walk(self, piece: bytes, lengths: list[int]) -> list[int]:
        """The tokens' ranks, read backwards from the last."""
        out, end = [], len(piece)
        while end:
            out.append(self.ranks[piece[end - lengths[end - 1] : end]])
            end -= lengths[end - 1]
        return out[::-1]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class PrefixEncoding:
    """The encoding of one piece that takes appends and edits."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b"") -> None:
        self.vocabulary, self.piece, self.lengths = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Add bytes; every stored last token stays as it is."""
        self.piece += more
        self.lengths = self.vocabulary.last_lengths(self.piece, self.lengths)

    def edit(self, start: int, end: int, replacement: bytes) -> None:
        """Replace the bytes from ``start`` to ``end``.

        Last tokens before the edit stay. Behind it they are found anew until, over the length of the longest token,
        they equal the old ones: from there on each depends on equal bytes and equal earlier entries only.
        """
        old_piece, old = self.piece, self.lengths
        self.piece = old_piece[:start] + replacement + old_piece[end:]
        lengths, shift, equal = old[:start], len(replacement) - (end - start), 0
        while len(lengths) < len(self.piece):
            self.vocabulary.last_lengths(self.piece[: len(lengths) + 1], lengths)
            place = len(lengths) - shift
            equal = equal + 1 if place > end and lengths[-1] == old[place - 1] else 0
            if equal >= self.vocabulary.longest:
                lengths += old[place:]
        self.lengths = lengths

    def ids(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.piece)
        return [whole] if whole is not None else self.vocabulary.walk(self.piece, self.lengths)


#: Prefixes whose last token a worker remembers, and the longest of them; a table that is full starts anew.
PREFIXES, LONGEST_PREFIX = 1_000_000, 24
#: Pieces whose encoding it remembers.
PIECES = 500_000


class Encoder:
    """Encodes whole texts piece by piece. Pieces share one table of prefixes and their last tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        self.vocabulary, self._find = vocabulary, regex.compile(pattern).findall
        self._last: dict[bytes, bytes] = {}
        self._seen: dict[str, tuple[int, ...]] = {}

    def encode_piece(self, piece: bytes) -> list[int]:
        """A piece that is a token as a whole is that token; others take the table of prefixes."""
        ranks, last, vocabulary = self.vocabulary.ranks, self._last, self.vocabulary
        whole = ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > LONGEST_PREFIX:
            return vocabulary.walk(piece, vocabulary.last_lengths(piece, []))
        if len(last) > PREFIXES:
            last.clear()
        out, rest = [], piece
        while rest:
            token = last.get(rest) or vocabulary.last_token_by_need(rest, last)
            out.append(ranks[token])
            rest = rest[: -len(token)]
        return out[::-1]

    def _ids_of(self, piece: str) -> tuple[int, ...]:
        if len(self._seen) > PIECES:
            self._seen.clear()
        self._seen[piece] = ids = tuple(self.encode_piece(piece.encode()))
        return ids

    def encode(self, text: str | None) -> list[int]:
        known, find = self._seen.get, self._ids_of
        return list(chain.from_iterable([known(piece) or find(piece) for piece in self._find(text or "")]))

    def decode(self, ids) -> bytes:
        return self.vocabulary.decode(ids)


#: What a worker process has met so far; kept from task to task.
_encoders: dict[tuple[str, str], Encoder] = {}


def encoded(
    docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
    make=None, schema: str = "ids array<int>, decoded binary",
) -> DataFrame:
    """(id, ids, decoded), or in place of the last two what ``make(ids, decoded)`` returns for ``schema``.

    The vocabulary file is read here once and sent to the executors; its size does not depend on the documents.
    """
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary(read_ranks(vocabulary_path)))
    fields = [field.strip().split()[0] for field in schema.split(", ")]
    make = make or (lambda ids, decoded: (ids, decoded))

    def run(batches):
        key = (vocabulary_path, pattern)
        if key not in _encoders:
            _encoders.clear()
            _encoders[key] = Encoder(vocabulary.value, pattern)
        encoder = _encoders[key]
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = []
                for text in part.column(1):
                    ids = encoder.encode(text.as_py())
                    rows.append(make(ids, encoder.decode(ids)))
                columns = zip(*rows, strict=True)
                yield pa.record_batch([part.column(0), *map(pa.array, columns)], ["id", *fields])

    return docs.select(F.col(id_col).cast("long").alias("id"), text_col).mapInArrow(run, f"id long, {schema}")


class _Names(dict):
    """Decimal names of ids, made once each."""

    def __missing__(self, number: int) -> str:
        self[number] = name = str(number)
        return name


_names = _Names()

DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS_AND_DIGESTS = f"ids array<int>, {DIGESTS}"


def digests_of(ids: list[int], decoded: bytes) -> tuple[int, str, str]:
    named = ",".join(map(_names.__getitem__, ids)).encode()
    return len(ids), hashlib.sha256(named).hexdigest(), hashlib.sha256(decoded).hexdigest()


def ids_and_digests(ids: list[int], decoded: bytes) -> tuple:
    return np.array(ids, np.int32), *digests_of(ids, decoded)


def digests(docs: DataFrame, vocabulary_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text, so that no ids need be kept."""
    return encoded(docs, vocabulary_path, pattern, id_col, text_col, digests_of, DIGESTS)
