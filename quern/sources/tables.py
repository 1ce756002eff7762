"""Layers of tables, full refreshes, views, and a record of every load."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.sources.clustering import clustered

LAYERS = ("bronze", "silver", "gold")


def create_layers(spark: SparkSession, layers=LAYERS, root: str | None = None) -> None:
    """Namespaces for the layers, each in a folder of ``root`` if that is given, else in the warehouse."""
    for layer in layers:
        place = f" LOCATION '{root.rstrip('/')}/{layer}'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}{place}")


def recreate_table(spark: SparkSession, name: str, schema: T.StructType | str) -> None:
    """Drop a table of that name and create it empty."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([], schema).write.saveAsTable(name)


def recreate_tables(spark: SparkSession, layer: str, schemas: dict[str, str]) -> None:
    """All tables of a layer, empty."""
    create_layers(spark, [layer])
    for table, schema in schemas.items():
        recreate_table(spark, f"{layer}.{table}", schema)


def append_table(df: DataFrame, name: str, truncate: bool = False) -> None:
    df.write.mode("overwrite" if truncate else "append").saveAsTable(name)


def publish_view(df: DataFrame, name: str) -> None:
    """A view that is computed whenever it is read."""
    df.createOrReplaceTempView(name)


#: Versions of a table that stay: the one that is read, and the one before it for readers that have begun.
VERSIONS = 2


@dataclass(frozen=True)
class Store:
    """Parquet tables under one root, a folder per layer and table with its versions.

    A load is written beside the versions, checked, and only then renamed to the next one, which is what readers find from
    then on. A load that fails leaves nothing behind, and readers the version before. One load of a table at a time.
    """

    root: str

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def versions(self, spark: SparkSession, layer: str, table: str) -> list[int]:
        """Numbers of the published versions, in order."""
        files, folder = _folder(spark, self.path(layer, table))
        names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
        return sorted(int(name[1:]) for name in names if name[0] == "v" and name[1:].isdigit())

    def current(self, spark: SparkSession, layer: str, table: str) -> str:
        """The folder of the newest version."""
        known = self.versions(spark, layer, table)
        if not known:
            raise LookupError(f"{layer}.{table} has not been loaded")
        return f"{self.path(layer, table)}/v{known[-1]:08d}"

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.read.parquet(self.current(spark, layer, table))

    def publish(self, spark: SparkSession, layer: str, tables: Iterable[str]) -> None:
        """Views named ``<layer>_<table>`` over stored tables."""
        for table in tables:
            publish_view(self.read(spark, layer, table), f"{layer}_{table}")

    def refresh(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        cluster_by: tuple[str, ...] = (),
        unique: tuple[str, ...] = (),
        files: int | None = None,
    ) -> int:
        """Replace the content by a new version, once it is written and checked; returns its number of rows.

        cluster_by: files hold near values of these keys (``clustering.clustered``), in ``files`` ranges if given.
        unique: columns that must identify a row and not be absent; otherwise the load fails.
        """
        spark, target = df.sparkSession, self.path(layer, table)
        loading = f"{target}/_load-{uuid.uuid4().hex}"
        system, folder = _folder(spark, loading)
        try:
            rows = clustered(df, cluster_by, files) if cluster_by else df
            # Counted behind the shuffle, whose sampling would count rows a second time.
            seen = Observation()
            rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(loading)
            if unique:
                _identified(spark.read.schema(df.schema).parquet(loading), unique, f"{layer}.{table}")
            known = self.versions(spark, layer, table)
            named = _folder(spark, f"{target}/v{known[-1] + 1 if known else 1:08d}")[1]
            if not system.rename(folder, named):
                raise OSError(f"{layer}.{table}: the new version could not be published")
        except BaseException:
            system.delete(folder, True)
            raise
        for old in known[: len(known) + 1 - VERSIONS]:
            system.delete(_folder(spark, f"{target}/v{old:08d}")[1], True)
        return seen.get["rows"]

    def file_ranges(self, spark: SparkSession, layer: str, table: str, keys: Iterable[str]) -> DataFrame:
        """For each file: its rows, and the smallest and largest value of each key (``<key>_min``, ``<key>_max``)."""
        ends = [end(key).alias(f"{key}_{end.__name__}") for key in keys for end in (F.min, F.max)]
        rows = self.read(spark, layer, table).withColumn("file", F.col("_metadata.file_name"))
        return rows.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ends)


def _folder(spark: SparkSession, name: str):
    """The file system of a path, and the path as it names it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _identified(rows: DataFrame, keys: tuple[str, ...], name: str) -> None:
    """Refuse rows whose keys are absent or occur twice; counts are combined before the shuffle."""
    absent = " OR ".join(f"`{k}` IS NULL" for k in keys)
    bad = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(f"__n > 1 OR {absent}").limit(1).collect()
    if bad:
        raise ValueError(f"{name}: {', '.join(keys)} do not identify a row: {bad[0]}")


@dataclass
class LoadRecord:
    layer: str
    table: str
    rows: int | None = None
    seconds: float | None = None
    status: str = "running"
    error: str | None = None
    started: float | None = None
    ended: float | None = None


@dataclass
class LoadAudit:
    """Rows, duration and outcome of each load. Rows are counted while they are written."""

    records: list[LoadRecord] = field(default_factory=list)

    def run(self, layer: str, table: str, df: DataFrame, write: Callable[[DataFrame], int | None]) -> None:
        """Write ``df``; a failure is recorded and raised again. ``write`` may return how many rows it has written."""
        record = LoadRecord(layer, table)
        self.records.append(record)
        record.started = time.time()
        try:
            seen = Observation()
            written = write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
            record.rows = seen.get["rows"] if written is None else written
            record.status = "loaded"
        except Exception as error:
            record.status, record.error = "failed", str(error)[:500]
            raise
        finally:
            record.ended = time.time()
            record.seconds = record.ended - record.started

    def run_all(self, layer: str, tables: dict[str, DataFrame], refresh: Callable, at_once: int = 4) -> None:
        """Write independent tables side by side, so that a small one does not leave the cluster idle."""
        with ThreadPoolExecutor(at_once) as pool:
            loads = [
                pool.submit(self.run, layer, table, df, partial(refresh, layer=layer, table=table))
                for table, df in tables.items()
            ]
        for load in loads:
            load.result()

    def total_seconds(self, layer: str | None = None) -> float:
        """Time from the start of the first load to the end of the last; loads may run side by side."""
        own = [r for r in self.records if r.ended and layer in (None, r.layer)]
        return max(r.ended for r in own) - min(r.started for r in own) if own else 0.0

    def frame(self, spark: SparkSession) -> DataFrame:
        schema = "layer string, table string, rows bigint, seconds double, status string, error string, started double, ended double"
        times = ("started", "ended")
        frame = spark.createDataFrame([tuple(asdict(r).values()) for r in self.records], schema)
        return frame.withColumns({name: F.timestamp_millis((F.col(name) * 1000).cast("bigint")) for name in times})
