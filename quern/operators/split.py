"""Division of a table into parts of exact size.

Every row gets a 64-bit hash of a seed and its columns; the rows with the smallest hashes form the test part,
the next ones the validation part. The cut is the hash at a known rank. It is found by counting hashes by
their leading 16 bits, then by the next 16 inside the bucket that holds the rank, and so on, so only counts
travel. The parts are then plain filters on the input: nothing is sorted or shuffled. Only when copies of
one row straddle a cut are those copies counted and dealt out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.frames import Splits, numeric_columns
from quern.operators.duplicates import copies
from quern.operators.ordering import global_index
from quern.operators.quantiles import exact_quantiles
from quern.staging import checkpointed

_BITS = 16
_FETCHED = 200_000


def test_rows(rows: int, share: float) -> int:
    return math.ceil(share * rows)


def row_hash(df: DataFrame, seed: int, columns: Sequence[str] | None = None) -> Column:
    """The hash by which rows are dealt; give ``columns`` when some identify a row, to read less."""
    return F.xxhash64(F.lit(seed), *(columns or df.columns))


def train_test_split(
    df: DataFrame,
    test_size: float = 0.2,
    random_state: int = 42,
    shuffle: bool = True,
    stratify_col: str | None = None,
    stratify_num_bins: int = 10,
    order_by: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> Splits:
    if not 0 < test_size < 1:
        raise ValueError(f"test size must lie between 0 and 1, got {test_size}")
    test, rest = _parts(df, [test_size], random_state, shuffle, stratify_col, stratify_num_bins, order_by, columns)
    return Splits(train=rest, test=test)


def train_test_val_split(
    df: DataFrame,
    test_size: float = 0.2,
    validation_size: float = 0.1,
    random_state: int = 42,
    shuffle: bool = True,
    stratify_col: str | None = None,
    stratify_num_bins: int = 10,
    order_by: Sequence[str] | None = None,
    columns: Sequence[str] | None = None,
) -> Splits:
    for label, size in (("test", test_size), ("validation", validation_size)):
        if not 0 < size < 1:
            raise ValueError(f"{label} size must lie between 0 and 1, got {size}")
    if test_size + validation_size >= 1:
        raise ValueError(f"test and validation size together must stay below 1, got {test_size + validation_size}")
    relative = validation_size / (1 - test_size)
    sizes = [test_size, relative]
    test, validation, rest = _parts(
        df, sizes, random_state, shuffle, stratify_col, stratify_num_bins, order_by, columns
    )
    return Splits(train=rest, test=test, validation=validation)


def _parts(df, sizes, seed, shuffle, stratify_col, bins, order_by, columns) -> list[DataFrame]:
    """One frame per size, each size taken of what the earlier ones left, and then the rest."""
    if not shuffle:
        if stratify_col:
            raise ValueError("a split in order cannot be stratified")
        if not order_by:
            raise ValueError("a split in order needs order_by")
        return _in_order(df, sizes, order_by)
    if stratify_col and stratify_col in df.columns:
        return _stratified(df, sizes, seed, strata(df, stratify_col, bins), columns)
    return _by_hash(df, sizes, seed, columns)


def _counts(rows: int, sizes: Sequence[float]) -> list[int]:
    taken = []
    for share in sizes:
        taken.append(test_rows(rows - sum(taken), share))
    if rows - sum(taken) < 1:
        raise ValueError(f"{rows} rows are too few for this split")
    return taken


def _in_order(df: DataFrame, sizes: Sequence[float], order_by: Sequence[str]) -> list[DataFrame]:
    numbered = global_index(df, order_by, "__n")
    end = numbered.agg(F.count(F.lit(1))).first()[0]
    parts = []
    for taken in _counts(end, sizes):
        parts.append(numbered.filter(F.col("__n").between(end - taken + 1, end)).drop("__n"))
        end -= taken
    return [*parts, numbered.filter(F.col("__n") <= end).drop("__n")]


@dataclass(frozen=True)
class _Cut:
    """Rows hashed below ``value`` lie before the cut, and ``share`` of the ``ties`` rows hashed to it."""

    value: int
    share: int
    ties: int


def _bucket_counts(hashes: DataFrame, bucket: Column) -> list[tuple[int, int]]:
    return sorted((row["p"], row["count"]) for row in hashes.groupBy(bucket.alias("p")).count().collect())


def _cut(hashes: DataFrame, leading: list[tuple[int, int]], rank: int) -> _Cut:
    """The hash of the row at a one-based rank, given the counts by leading bits."""
    counts, depth, before = leading, _BITS, 0
    while True:
        for prefix, inside in counts:
            if before + inside >= rank:
                break
            before += inside
        if depth == 64:
            return _Cut(prefix, rank - before, inside)
        within = hashes.filter(F.shiftright("h", 64 - depth) == prefix)
        depth = 64 if inside <= _FETCHED else depth + _BITS
        counts = _bucket_counts(within, F.shiftright("h", 64 - depth) if depth < 64 else F.col("h"))


def _by_hash(df: DataFrame, sizes, seed, columns) -> list[DataFrame]:
    hashed = row_hash(df, seed, columns)
    hashes = df.select(hashed.alias("h"))
    leading = _bucket_counts(hashes, F.shiftright("h", 64 - _BITS))
    cuts, rank = [], 0
    for taken in _counts(sum(size for _, size in leading), sizes):
        rank += taken
        cuts.append(_cut(hashes, leading, rank))
    parts = []
    for lower, upper in zip([None, *cuts], [*cuts, None]):
        inside = F.lit(True)
        if upper is not None:
            whole = upper.share == upper.ties
            inside = inside & (hashed <= upper.value if whole else hashed < upper.value)
        if lower is not None:
            inside = inside & (hashed > lower.value)
        part = df.filter(inside)
        for value, first, last in _shared_ties(lower, upper):
            part = part.unionByName(_dealt(df, hashed, value, first, last))
        parts.append(part)
    return parts


def _shared_ties(lower: _Cut | None, upper: _Cut | None) -> list[tuple[int, int, int]]:
    """The stretches [first, last) of equally hashed rows that this part receives."""
    if lower is not None and upper is not None and lower.value == upper.value:
        return [(lower.value, lower.share, upper.share)]
    shared = []
    if lower is not None and lower.share < lower.ties:
        shared.append((lower.value, lower.share, lower.ties))
    if upper is not None and upper.share < upper.ties:
        shared.append((upper.value, 0, upper.share))
    return shared


def _dealt(df: DataFrame, hashed: Column, value: int, first: int, last: int) -> DataFrame:
    """Copies number first..last-1 of the rows with this hash, kept as counts until written out."""
    tied = df.filter(hashed == value)
    counted = tied.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    # One distinct row, or very few if hashes collide, so this order is over a handful of counts.
    running = Window.partitionBy(F.lit(0)).orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, 0)
    upto = counted.withColumn("__to", F.sum("__copies").over(running))
    start = F.greatest(F.col("__to") - F.col("__copies"), F.lit(first))
    sized = upto.withColumn("__copies", F.least(F.col("__to"), F.lit(last)) - start).drop("__to")
    return copies(sized, "__copies")


def strata(df: DataFrame, name: str, bins: int = 10) -> Column:
    """The class by which a split is balanced: the value, or its quantile bin for a many-valued number."""
    if name not in numeric_columns(df):
        return F.col(name)
    values = df.agg(F.count_distinct(name)).first()[0]
    return quantile_bin(df, name, bins) if values > max(2 * bins, 25) else F.col(name)


def bin_edges(df: DataFrame, name: str, bins: int) -> list[float]:
    """Quantile edges with repeated ones dropped."""
    edges = exact_quantiles(df, [name], [i / bins for i in range(bins + 1)])[name]
    return sorted(set(e for e in edges if e is not None))


def quantile_bin(df: DataFrame, name: str, bins: int) -> Column:
    """Number of the right-closed quantile bin, from 0; the lowest edge belongs to the first bin."""
    edges = bin_edges(df, name, bins)
    if len(edges) < 2:
        return F.lit(None).cast("int")
    value = F.col(name).cast("double")
    chain = F.when(value < edges[0], F.lit(None))
    for number, upper in enumerate(edges[1:]):
        chain = chain.when(value <= upper, F.lit(number))
    return chain


def _stratified(df: DataFrame, sizes, seed, stratum: Column, columns) -> list[DataFrame]:
    """Each class contributes its share to every part; leftovers go to the largest remainders.

    All state per class is a table, so the number of classes is not limited by the driver.
    """
    hashed = df.withColumns({"__s": stratum, "__h": row_hash(df, seed, columns)})
    classes = checkpointed(hashed.groupBy("__s").agg(F.count(F.lit(1)).alias("n")))
    rows, smallest, kinds = classes.agg(F.sum("n"), F.min("n"), F.count(F.lit(1))).first()
    if smallest < 2:
        raise ValueError("the least frequent class has one row only, at least 2 are needed")
    quotas, left, totals = classes.withColumn("left", F.col("n")), rows, _counts(rows, sizes)
    for part, taken in enumerate(totals):
        if min(taken, left - taken) < kinds:
            raise ValueError(f"{kinds} classes do not fit into a part of {min(taken, left - taken)} rows")
        quotas = checkpointed(_with_quota(quotas, f"k{part}", taken, left))
        left -= taken
    ends, ranks = F.lit(0), []
    for part in range(len(totals)):
        ends = ends + F.col(f"k{part}")
        ranks.append(F.struct(F.lit(part).alias("part"), ends.alias("rank")))
    wanted = quotas.select("__s", F.inline(F.array(*ranks))).filter("rank > 0")
    cuts = _cuts_per_class(hashed, wanted)
    # A class too small to contribute to a part has no cut there: nothing of it lies below.
    columns_of = {"cut": -(1 << 63), "share": 0, "ties": 0}
    wide = [
        F.coalesce(F.max(F.when(F.col("part") == part, F.col(c))), F.lit(default)).alias(f"{c}{part}")
        for part in range(len(totals))
        for c, default in columns_of.items()
    ]
    placed = quotas.select(F.col("__s").alias("__c")).join(cuts, F.col("__c").eqNullSafe(F.col("__s")), "left")
    cuts = checkpointed(placed.groupBy("__c").agg(*wide))
    divided = F.lit(False)
    for part in range(len(totals)):
        divided = divided | (F.col(f"share{part}") < F.col(f"ties{part}"))
    tied = cuts.filter(divided).limit(1).count() > 0
    joined = hashed.join(cuts, F.col("__s").eqNullSafe(F.col("__c")), "left")
    return [_class_part(df, joined, part, len(totals), tied) for part in range(len(totals) + 1)]


def _with_quota(classes: DataFrame, name: str, taken: int, left: int) -> DataFrame:
    """Largest-remainder shares of ``taken`` rows over the rows each class has left."""
    exact = F.col("left") * F.lit(taken) / F.lit(left)
    shares = classes.withColumns({name: F.floor(exact).cast("bigint"), "__rest": exact - F.floor(exact)})
    short = taken - shares.agg(F.sum(name)).first()[0]
    # Numbered in ranges: with many classes the leftovers are many rows too, which one task must not sort.
    ranked = global_index(shares.select("__s", "__rest", "n"), [("__rest", "desc"), ("n", "desc"), "__s"], "__rank", stage_input=False)
    extra = ranked.filter(F.col("__rank") <= short).select(F.col("__s").alias("__e"), F.lit(1).alias("__one"))
    topped = shares.join(extra, F.col("__s").eqNullSafe(F.col("__e")), "left")
    total = F.col(name) + F.coalesce("__one", F.lit(0))
    return topped.withColumn(name, total).withColumn("left", F.col("left") - F.col(name)).drop("__e", "__one", "__rest")


def _cuts_per_class(hashed: DataFrame, ranks: DataFrame) -> DataFrame:
    """For every class and part the hash at its rank, by counts over further bits per round."""
    state, depth, last = ranks.withColumn("before", F.lit(0).cast("bigint")), 0, False
    while not last:
        known = state.withColumnRenamed("__s", "__c")
        same = F.col("__s").eqNullSafe(F.col("__c"))
        last = depth == 64 - _BITS or (depth > 0 and state.agg(F.max("ties")).first()[0] <= 1 << _BITS)
        bucket = F.col("__h") if last else F.shiftright("__h", 64 - depth - _BITS)
        if depth == 0:
            # One count serves all parts; only counts meet the wanted ranks.
            counted = hashed.groupBy("__s", bucket.alias("p")).count().join(known, same)
        else:
            within = same & (F.shiftright("__h", 64 - depth) == F.col("prefix"))
            matched = hashed.select("__s", "__h", bucket.alias("p")).join(known, within)
            counted = matched.groupBy("__s", "part", "rank", "before", "p").count()
        # At most 65,536 counts per class, part and round.
        running = Window.partitionBy("__s", "part").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
        upto = counted.withColumn("upto", F.col("before") + F.sum("count").over(running))
        hit = upto.filter((F.col("upto") >= F.col("rank")) & (F.col("upto") - F.col("count") < F.col("rank")))
        state = checkpointed(
            hit.select(
                "__s",
                "part",
                "rank",
                F.col("p").alias("prefix"),
                (F.col("upto") - F.col("count")).alias("before"),
                F.col("count").alias("ties"),
            )
        )
        depth += _BITS
    return state.select(
        "__s", "part", F.col("prefix").alias("cut"), (F.col("rank") - F.col("before")).alias("share"), "ties"
    )


def _class_part(df: DataFrame, joined: DataFrame, part: int, cuts: int, tied: bool) -> DataFrame:
    position, inside, shared = F.col("__h"), F.lit(True), F.lit(False)
    if part < cuts:
        upper = F.col(f"cut{part}")
        whole = F.col(f"share{part}") == F.col(f"ties{part}")
        inside = inside & ((position < upper) | ((position == upper) & whole))
        shared = shared | ((position == upper) & ~whole)
    if part > 0:
        lower = F.col(f"cut{part - 1}")
        inside = inside & (position > lower)
        shared = shared | ((position == lower) & (F.col(f"share{part - 1}") < F.col(f"ties{part - 1}")))
    rows = joined.filter(inside & ~shared).select(*df.columns)
    return rows.unionByName(_class_ties(df, joined.filter(shared), part, cuts)) if tied else rows


def _class_ties(df: DataFrame, tied: DataFrame, part: int, cuts: int) -> DataFrame:
    """The copies this part receives of rows whose hash is the cut of their class."""
    at_upper = F.col("__h") == F.col(f"cut{part}") if part < cuts else F.lit(False)
    at_lower = F.col("__h") == F.col(f"cut{part - 1}") if part > 0 else F.lit(False)
    first = F.when(at_lower, F.col(f"share{part - 1}") if part > 0 else F.lit(0)).otherwise(F.lit(0))
    last = F.when(at_upper, F.col(f"share{part}") if part < cuts else F.lit(0)).otherwise(
        F.col(f"ties{part - 1}") if part > 0 else F.lit(0)
    )
    stretch = tied.withColumns({"__first": first.cast("bigint"), "__last": last.cast("bigint")})
    counted = stretch.groupBy("__s", "__h", "__first", "__last", *df.columns).agg(
        F.count(F.lit(1)).alias("__copies")
    )
    running = (
        Window.partitionBy("__s", "__h").orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, 0)
    )
    upto = counted.withColumn("__to", F.sum("__copies").over(running))
    start = F.greatest(F.col("__to") - F.col("__copies"), F.col("__first"))
    sized = upto.withColumn("__copies", F.least(F.col("__to"), F.col("__last")) - start)
    return copies(sized.select(*df.columns, "__copies"), "__copies")
