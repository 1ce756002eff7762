"""Delimited files in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quern.frames import Data, Splits
from quern.sources.records import records


QUOTING = {"quote": '"', "escape": '"'}


def _of_records(spark: SparkSession, found: DataFrame, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Columns of records, each a text of its own, by Spark's reader."""
    reader = spark.read.options(**QUOTING, **options)
    reader = reader if schema is None else reader.schema(schema)
    texts = getattr(found.select("value")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(reader._jreader.csv(texts), spark)


def _named(spark: SparkSession, path: str, infer: bool) -> DataFrame:
    """Columns named by the first record of a file. Nameless and repeated names get their place as the reader gives them."""
    found = records(spark, path)
    head = found.filter("first").orderBy("value").limit(1)
    data = _of_records(spark, found.filter("NOT first"), inferSchema=infer)
    given = list(_of_records(spark, head).first() or ())
    if len(given) > len(data.columns):  # no record beside the first
        data = spark.createDataFrame([], T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(given))]))
    folded = [(name or "").lower() for name in given]
    names = [
        f"_c{i}" if not name else f"{name}{i}" if folded.count(name.lower()) > 1 else name for i, name in enumerate(given)
    ]
    return data.toDF(*names, *data.columns[len(names) :])


def read_positional(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    quoted: bool = False,
    mode: str = "FAILFAST",
    multi_line: bool | None = None,
) -> DataFrame:
    """Columns bound by position to a declared schema, the header line skipped whatever it says.

    Without ``quoted`` a quote is an ordinary character. A value that does not fit its type fails the load. Quoted
    values may hold line breaks; ends of records are then found by many tasks (``records``). ``multi_line=True`` reads
    each file in one task instead, for files with quotes outside quoted values, and ``False`` takes every line for a
    record.
    """
    if quoted and multi_line is None:
        return _of_records(spark, records(spark, path).filter("NOT first"), schema, mode=mode, sep=",")
    return spark.read.csv(
        path, schema=schema, header=True, enforceSchema=True, sep=",", mode=mode, encoding="UTF-8",
        multiLine=bool(multi_line), **(QUOTING if quoted else {"quote": ""}),
    )


def read_inferred(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Columns by name with types inferred from the data: for files met once, at the price of another scan."""
    if multi_line is None:
        return _named(spark, path, infer=True)
    return spark.read.csv(path, header=True, inferSchema=True, multiLine=multi_line, **QUOTING)


def read_text_columns(spark: SparkSession, path: str, multi_line: bool | None = None) -> DataFrame:
    """Columns by name, every value as text."""
    if multi_line is None:
        return _named(spark, path, infer=False)
    return spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, **QUOTING)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A header, no index, absent values as nothing, outer blanks of text kept."""
    df.write.mode(mode).csv(
        path, header=True, nullValue="", emptyValue="", quote='"', escape='"', encoding="UTF-8",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def export(data: Data, name: str) -> list[str]:
    """One output for a table, one per part for splits; returns the paths written."""
    base = name[: -len(".csv")] if name.lower().endswith(".csv") else name
    if isinstance(data, Splits):
        paths = {f"{base}_{label.lower()}.csv": df for label, df in data.items()}
    else:
        paths = {f"{base}.csv": data}
    for path, df in paths.items():
        write_csv(df, path)
    return list(paths)
