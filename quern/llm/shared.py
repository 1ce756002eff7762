"""What several operators of this folder need: whole-text words, written stages, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quern import staging

#: Characters between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
UNSIGNED_32 = 0xFFFFFFFF


class Stage:
    """Frames written once to the shared folder; ``drop`` deletes those that no later plan reads."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self._paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        path = staging.new_path(self.spark)
        df.write.parquet(path)
        self._paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *frames: DataFrame) -> None:
        """Delete the files of ``frames`` made by ``keep``."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for frame in frames:
            for path in [p for p in self._paths if any(p in f for f in frame.inputFiles()[:1])]:
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(conf).delete(target, True)
                self._paths.remove(path)


def byte_words(text: str | None) -> list[bytes]:
    """The maximal runs of bytes other than blanks; none for a null text.

    ``bytes.split`` divides at exactly the six blanks of ``BLANKS`` and at no other white space.
    """
    return text.encode().split() if text else []


def native_words(text: Column) -> Column:
    """The words of a text as an array, empty for a null text, by SQL functions only."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), "")


def by_batch(
    df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: StructType | str
) -> DataFrame:
    """Apply ``make`` to each Arrow batch of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = make(batch)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long), root being the smallest node it reaches.

    Alternates the large and the small star step until the edges stay as they are, which takes a number of rounds
    logarithmic in the number of nodes. A step joins each edge with the smallest neighbour of its ends, found by
    an aggregation that combines before it shuffles, so a node with very many neighbours is no group of its own.
    """

    def both(e: DataFrame) -> DataFrame:
        return e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def large(e: DataFrame) -> DataFrame:
        every = both(e)
        least = every.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        return every.filter("b > a").join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = down.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionAll(least.select("a", F.col("m").alias("b")))

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = stage.keep(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    known = state(now)
    while known[0]:
        after = stage.keep(small(large(now).distinct()).distinct())
        told = state(after)
        stage.drop(now)
        now = after
        if told == known:
            break
        known = told
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
