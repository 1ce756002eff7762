"""A mix of sources by weighted fair queueing.

Each source's documents are shuffled by a hash and queued, the whole queue twice. A copy's virtual finish time is the
words of its source up to and including it, divided by the source's target. Copies of all sources are then sorted by
that time, by ranges, and taken from the front until the budget is reached. A source whose target is twice its size
so ends with its second round, and no document is taken more than twice.

Targets share the budget by weight, but none exceeds twice its source's size; what lies above is shared again among
the others, until none is above. The result is the level at which the capped shares add up to the budget.

Running sums go by cells of the shuffle: cells are added up, their sums are summed before, and rows are summed inside
their cell. So a source with a third of all rows is many tasks.

Defined results: a null text has no words. A null source is a source, ordered last. Documents without words take 0. A
null id keeps its row; repeated rows are rows of their own. An empty table gives no rows. Columns other than those
named are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quern.llm.shared import Stage, native_words
from quern.operators.ordering import global_index

#: Times that a document can be taken.
ROUNDS = 2
#: Documents that are summed up together.
CELL_ROWS = 5_000


def word_count(text: Column) -> Column:
    return F.size(native_words(text)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...], share: float) -> DataFrame:
    """``sources`` (source, total, ...) with ``weight`` and ``target``. Weights repeat in the order of code points.

    Sources are numbered by ranges, since there may be very many.
    """
    ranked = global_index(sources.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "_rank", start=0)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    weighed = ranked.withColumn("weight", weight.cast("double")).drop("_rank", "_none")
    budget = share * float(weighed.agg(F.sum("total")).first()[0] or 0)
    level = 0.0
    while True:
        capped = F.col("total") * ROUNDS < F.lit(level) * F.col("weight")
        full, rest = weighed.agg(
            F.sum(F.when(capped, F.col("total") * ROUNDS).otherwise(0)), F.sum(F.when(~capped, F.col("weight")).otherwise(0))
        ).first()
        if not rest:
            break
        higher = (budget - float(full)) / float(rest)
        if higher <= level:
            break
        level = higher
    return weighed.withColumn("target", F.least(F.col("total") * float(ROUNDS), F.lit(level) * F.col("weight")))


def _running(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with their source's columns and ``upto``, the words of the source's queue up to and with each row."""
    cells = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(CELL_ROWS))).cast("long")
    known = rows.withColumnRenamed("source", "_source").join(sources, F.col("_source").eqNullSafe(F.col("source")))
    dealt = known.drop("_source").withColumn("_cell", F.pmod(F.col("mixed"), cells))
    sums = dealt.groupBy(F.col("number").alias("_number"), F.col("_cell").alias("_in")).agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("_number").orderBy("_in").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_number", "_in", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("number", "_cell").orderBy("mixed", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    return (
        dealt.withColumn("_inside", F.sum("size").over(inside))
        .join(offsets, (F.col("number") == F.col("_number")) & (F.col("_cell") == F.col("_in")))
        .withColumn("upto", F.col("_inside") + F.col("_before"))
        .drop("_inside", "_before", "_number", "_in", "_cell")
    )


def _finish(times: int) -> Column:
    """The virtual finish time of a row's copy in round ``times``, counted from 0."""
    return (F.col("upto") + F.col("total") * times) / F.col("target")


def last_finish(queue: DataFrame, budget: float, stage: Stage) -> float:
    """The largest finish time up to which all copies together stay within the budget; -1 if none does."""
    copies = queue.filter("size > 0").select(
        F.explode(F.array(*(F.struct(_finish(k).alias("finish"), "size") for k in range(ROUNDS)))).alias("c")
    )
    parts = int(queue.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal times share a range; only sources can tie, since times rise within one.
    ranged = stage.keep(
        copies.select("c.*").repartitionByRange(parts, "finish").withColumn("range", F.spark_partition_id())
    )
    sums = ranged.groupBy("range").agg(F.sum("size").alias("size"), F.max("finish").alias("finish"))
    before, best = 0, -1.0
    for row in sorted(sums.collect(), key=lambda r: r.finish):  # a row for each range
        if before + row.size <= budget:
            before, best = before + row.size, row.finish
            continue
        within = W.orderBy("finish").rangeBetween(W.unboundedPreceding, 0)
        inside = ranged.filter(F.col("range") == row.range).groupBy("finish").agg(F.sum("size").alias("size"))
        reached = inside.withColumn("_sum", F.sum("size").over(within)).filter(F.col("_sum") <= F.lit(budget - before))
        found = reached.agg(F.max("finish")).first()[0]
        return best if found is None else float(found)
    return best


def mixed_hash(id_col: str, text_col: str) -> Column:
    """What the shuffle goes by."""
    return F.xxhash64(F.col(id_col), F.col(text_col), F.lit("mix"))


def queue_and_cut(
    docs: DataFrame, weights: tuple[int, ...], share: float, id_col: str, text_col: str, source_col: str
) -> DataFrame:
    """(id, source, size, mixed, total, target, upto, times): the queues, and how often the mix takes each row."""
    stage = Stage(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        mixed_hash(id_col, text_col).alias("mixed"),
    )
    rows = stage.keep(rows)
    sources = rows.groupBy("source").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"))
    sources = sources.withColumn("number", F.xxhash64(F.struct("source")))
    sources = stage.keep(targets(sources, weights, share))
    queue = stage.keep(_running(rows, sources))
    budget = float(sources.agg(F.sum("target")).first()[0] or 0)
    # Half a word covers the rounding of the targets' sum.
    last = last_finish(queue, budget + 0.5, stage)
    taken = (F.when((F.col("size") > 0) & (_finish(k) <= F.lit(last)), 1).otherwise(0) for k in range(ROUNDS))
    return queue.withColumn("times", sum(taken, F.lit(0)))


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """(id, size, source_size, target, taken): the words that the mix takes of each row."""
    queue = queue_and_cut(docs, weights, share, id_col, text_col, source_col)
    taken = (F.col("size") * F.col("times")).cast("long").alias("taken")
    return queue.select("id", "size", F.col("total").alias("source_size"), "target", taken)


def mixed_rows(
    docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``docs`` as the mix has them: each row as often as it is taken.

    Rows are found again by their hash and id. Copies of a row share what is taken of all of them.
    """
    queue = queue_and_cut(docs, weights, share, id_col, text_col, source_col)
    taken = queue.groupBy(F.col("mixed").alias("__mixed"), F.col("id").alias("__id"), F.col("source").alias("__source"))
    taken = taken.agg(F.sum("times").alias("__times"), F.count(F.lit(1)).alias("__copies")).filter("__times > 0")
    own = docs.withColumn("__own", mixed_hash(id_col, text_col))
    same = (
        (F.col("__own") == F.col("__mixed"))
        & F.col(id_col).eqNullSafe(F.col("__id"))
        & F.col(source_col).eqNullSafe(F.col("__source"))
    )
    found = own.join(taken, same)
    copy = F.row_number().over(W.partitionBy("__own", id_col, source_col).orderBy("__own"))
    more = (F.col("__copy") <= F.col("__times") % F.col("__copies")).cast("int")
    times = (F.floor(F.col("__times") / F.col("__copies")) + more).cast("int")
    spread = found.withColumn("__copy", copy).withColumn("__each", F.explode(F.array_repeat(F.lit(0), times)))
    return spread.select(*docs.columns)
