"""Lines that many documents share, dropped from all but the last of them.

Texts are exploded into lines; a line's key is the line without outer blanks and with A-Z in lower case, held as two
64-bit hashes. Documents are counted per key, keys over the threshold are joined back to the places of their lines, and
each text is put together again from the stretches between the places it loses. Only functions of SQL are used.

A key may be in a third of all rows. Rows are therefore dealt to ``SALTS`` salts by a hash of their id and text. Counting
combines per partition and then by key and id, so no key is one group of rows. A dropped key is copied once for each
salt it occurs under, which counting notes as the bits of one number, and lines meet it by key and salt.

Defined results: a null text has one empty line, as an empty one has, and gives an empty text. Rows with one id are one
document, whether their texts are equal or not: each row is answered, and rows of the largest id keep the line in all of
them. Null ids are one document that comes before all others. A line that occurs twice in the last document stays twice.
An empty table gives no rows. Other columns are kept; those named like the added ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Characters taken off both ends of a line: space, tab, line feed, vertical tab, form feed, carriage return.
OUTER = " \t\n\x0b\x0c\r"
#: Parts of the rows that hold one key; at most 63, the bits of a long.
SALTS = 60


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without outer blanks, A-Z in lower case and no other letter changed."""
    bare = F.trim(line, F.lit(OUTER))
    # Only texts of one byte a character can be lowered as a whole: other letters must stay as they are.
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _keyed(row: DataFrame, least_chars: int) -> DataFrame:
    """(id, text hash, salt, place, k1, k2) of each line that is long enough."""
    line = row.select("__id", "__th", "__salt", F.posexplode(lines_of(F.col("__text"))).alias("__at", "__line"))
    line = line.withColumn("__key", line_key(F.col("__line"))).filter(F.char_length("__key") >= least_chars)
    return line.select(
        "__id", "__th", "__salt", "__at",
        F.xxhash64("__key").alias("__k1"), F.xxhash64(F.lit("second"), "__key").alias("__k2"),
    )


def without_shared_lines(
    docs: DataFrame, least_chars: int = 20, documents: int = 3, id_col: str = "doc_id", text_col: str = "text",
    out_col: str = "kept", lines_col: str = "n_lines", dropped_col: str = "n_dropped",
) -> DataFrame:
    """``docs`` with the text that is left, the number of lines before, and that of lines dropped.

    A key of at least ``least_chars`` code points that is found in ``documents`` documents or more loses its lines in
    all documents but the one with the largest id.
    """
    kept = [c for c in docs.columns if c not in {out_col, lines_col, dropped_col} - {text_col}]
    row = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
        F.xxhash64(text_col).alias("__th"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(SALTS)).cast("int").alias("__salt"),
        F.struct(*[F.col(f"`{c}`") for c in kept if c != text_col], F.lit(None)).alias("__row"),
    )
    line = _keyed(row, least_chars)

    # One of the two shuffles is by key and id, so a key in very many documents is spread; the other moves sums.
    counted = line.groupBy("__k1", "__k2").agg(
        F.count_distinct("__id").alias("ids"),
        F.max(F.col("__id").isNull().cast("int")).alias("nameless"),
        F.max("__id").alias("__last"),
        F.expr("bit_or(shiftleft(1L, __salt))").alias("salts"),
    )
    shared = counted.filter(F.col("ids") + F.col("nameless") >= documents)
    salts = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: F.expr("salts").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), s)) != 0)
    shared = shared.select("__k1", "__k2", "__last", F.explode(salts).alias("__salt"))

    hit = line.join(shared, ["__k1", "__k2", "__salt"]).filter(~F.col("__id").eqNullSafe(F.col("__last")))
    places = hit.groupBy(F.col("__id").alias("__of"), F.col("__th").alias("__oth")).agg(
        F.sort_array(F.collect_set("__at")).alias("__gone")
    )
    joined = row.join(places, F.col("__id").eqNullSafe(F.col("__of")) & (F.col("__th") == F.col("__oth")), "left")

    # Every stretch between two places that go is cut out of the array of lines once.
    gone = F.col("__gone")
    every = joined.withColumn("__lines", lines_of(F.col("__text")))
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(gone, i - 1) + 1)
    end = lambda i: F.coalesce(F.get(gone, i), F.size("__lines"))
    stretches = F.transform(
        F.sequence(F.lit(0), F.size(gone)), lambda i: F.slice(F.col("__lines"), start(i) + 1, end(i) - start(i))
    )
    text = F.when(gone.isNull(), F.coalesce("__text", F.lit(""))).otherwise(F.array_join(F.flatten(stretches), "\n"))
    return every.select(
        *[F.col("__text").alias(c) if c == text_col else F.col(f"__row.`{c}`") for c in kept if c != out_col],
        text.alias(out_col),
        F.size("__lines").cast("long").alias(lines_col),
        F.when(gone.isNull(), 0).otherwise(F.size(gone)).cast("long").alias(dropped_col),
    )


def digests(docs: DataFrame, least_chars: int = 20, documents: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256)."""
    found = without_shared_lines(docs.select("doc_id", "text"), least_chars, documents)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
