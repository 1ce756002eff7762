"""Quality rules under weak supervision.

Each rule votes that a document is good or bad, or abstains. Nothing is labelled: expectation-maximisation over the
votes of all documents estimates the share of good documents and how often each rule is right, and a document's
posterior probability of being good, in the light of these, decides. So one failed rule no longer throws a document out.

Every number comes from whole texts by SQL functions; documents are reduced to their patterns of votes, of which there
are at most three to the number of rules, and only those counts reach the driver.

Defined results: a null or blank text has no words; its rules abstain, and the limits of ``base_failed`` reject it.
Repeated rows count each time in the estimates and keep their rows, as does a null id. An empty table gives no rows.
Columns other than those named are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import Stage, native_words

SYMBOLS = r"[#*$%&|<>]"
WINDOW = 5
#: Words of a stretch whose distinct words are counted, so that their share does not fall with the length of a text.
STRETCH = 500
#: A word of letters (joined by an apostrophe or hyphen at most) or digits, with at most two marks behind it.
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])(?:\p{L}++(?:['’-]\p{L}++)*+|[0-9]++)[.,;:!?)]?[.,;:!?)\"']?(?![^\x20\x09-\x0D])"


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every whole text that the rules look at."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("_text"), native_words(F.col(text_col)).alias("_words"))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    lines = F.expr(r"filter(split(_text, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')")
    windows = F.expr(
        f"""IF(n_words < {WINDOW}, CAST(array() AS array<bigint>), transform(sequence(0, CAST(n_words - {WINDOW} AS INT)),
        i -> xxhash64({", ".join(f"_words[i + {k}]" for k in range(WINDOW))})))"""
    )
    rows = rows.withColumns({"_lines": lines, "_windows": windows})
    rows = rows.select(
        "id",
        "n_words",
        F.length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("_text", F.lit(r"\p{L}")).cast("long").alias("n_letters"),
        F.regexp_count("_text", F.lit(PLAIN_WORD)).cast("long").alias("n_plain"),
        F.expr(
            f"""CAST(aggregate(sequence(0, CAST((n_words - 1) div {STRETCH} AS INT)), 0,
            (n, k) -> n + size(array_distinct(slice(_words, {STRETCH} * k + 1, {STRETCH})))) AS BIGINT)"""
        ).alias("n_distinct"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        "_windows",
        (F.size(F.array_distinct("_windows")) < F.size("_windows")).alias("_repeats"),
    )
    # Only for texts in which some window is found again: sort windows by hash and place, keep those beside an equal
    # one, and add up the words that their places cover.
    ordered = F.expr("IF(_repeats, array_sort(transform(_windows, (h, i) -> struct(h, i))), NULL)")
    rows = rows.withColumn("_ordered", ordered).drop("_windows")
    again = """IF(_repeats, array_sort(transform(filter(sequence(0, size(_ordered) - 1),
        k -> (k > 0 AND _ordered[k].h = get(_ordered, k - 1).h) OR _ordered[k].h <=> get(_ordered, k + 1).h),
        k -> _ordered[k].i)), NULL)"""
    rows = rows.withColumn("_places", F.expr(again)).drop("_ordered")
    covered = f"""IF(_repeats, aggregate(sequence(0, size(_places) - 1), 0L,
        (n, k) -> n + least({WINDOW}, coalesce(get(_places, k + 1) - _places[k], {WINDOW}))), 0L)"""
    return rows.withColumn("n_repeat_words", F.expr(covered)).drop("_places", "_repeats")


def vote(good: Column, bad: Column) -> Column:
    """1 if good, else -1 if bad, else 0: the rule abstains."""
    return F.when(good, 1).when(bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes, from the columns of ``measures``."""
    words, chars = F.col("n_words"), F.col("word_chars")
    some = words > 0
    return {
        "word_length": vote(some & chars.between(3 * words, 10 * words), some & ~chars.between(2 * words, 15 * words)),
        "symbols": vote(some & (20 * F.col("n_symbols") <= words), 5 * F.col("n_symbols") > words),
        "letters": vote(some & (100 * F.col("n_letters") >= 90 * chars), 100 * F.col("n_letters") < 75 * chars),
        "plain_words": vote(some & (10 * F.col("n_plain") >= 9 * words), 10 * F.col("n_plain") < 7 * words),
        "dup_lines": vote(some & (F.col("n_dup_lines") == 0), 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
        "repeats": vote(some & (50 * F.col("n_repeat_words") <= words), 10 * F.col("n_repeat_words") > words),
        "capitals": vote(some & (5 * F.col("n_upper") <= chars), 2 * F.col("n_upper") > chars),
        "variety": vote(some & (10 * F.col("n_distinct") >= 4 * words), 5 * F.col("n_distinct") < words),
        "line_length": vote(some & (words >= 5 * F.col("n_lines")), words < 2 * F.col("n_lines")),
    }


@dataclass
class Estimate:
    """What expectation-maximisation found: the share of good documents, and how often each rule that votes is right
    about good and about bad ones."""

    share: float
    on_good: dict[str, float]
    on_bad: dict[str, float]

    def odds(self, votes: dict[str, int]) -> float:
        """The logarithm of the odds that a document with these votes is good."""
        out = math.log(self.share / (1 - self.share))
        for name, v in votes.items():
            g, b = self.on_good[name], self.on_bad[name]
            out += math.log(g / (1 - b)) if v > 0 else math.log((1 - g) / b) if v < 0 else 0.0
        return out

    def posterior(self) -> Column:
        """The probability that a document is good, from its columns of votes."""
        odds = F.lit(math.log(self.share / (1 - self.share)))
        for name, g in self.on_good.items():
            b = self.on_bad[name]
            told = F.when(F.col(name) > 0, math.log(g / (1 - b))).when(F.col(name) < 0, math.log((1 - g) / b))
            odds = odds + told.otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def estimate(patterns: list[tuple[tuple[int, ...], int]], names: list[str], rounds: int = 200) -> Estimate:
    """Expectation-maximisation over patterns of votes and their counts.

    A rule is right about good documents nine times in ten at least (at most 999 of 1,000), and about bad ones at
    least one time in twenty (at most 99 of 100): most kinds of bad text trouble a few rules only. The share of good
    ones lies between 0.05 and 0.95. So the two classes can't change names.
    """
    now = Estimate(0.85, dict.fromkeys(names, 0.97), dict.fromkeys(names, 0.25))
    patterns = sorted(patterns)
    total = sum(n for _, n in patterns)

    def between(low: float, x: float, high: float) -> float:
        return min(high, max(low, x))

    for _ in range(rounds if total else 0):
        good = 0.0
        told = {name: [0.0] * 4 for name in names}  # right about good, good, right about bad, bad
        for votes, n in patterns:
            named = dict(zip(names, votes, strict=True))
            p = 1 / (1 + math.exp(-between(-700, now.odds(named), 700)))
            good += n * p
            for name, v in named.items():
                if v:
                    t = told[name]
                    t[0] += n * p * (v > 0)
                    t[1] += n * p
                    t[2] += n * (1 - p) * (v < 0)
                    t[3] += n * (1 - p)
        after = Estimate(
            between(0.05, good / total, 0.95),
            {k: between(0.9, t[0] / t[1], 0.999) if t[1] else now.on_good[k] for k, t in told.items()},
            {k: between(0.05, t[2] / t[3], 0.99) if t[3] else now.on_bad[k] for k, t in told.items()},
        )
        moved = max(abs(x[k] - y[k]) for x, y in ((now.on_good, after.on_good), (now.on_bad, after.on_bad)) for k in names)
        now = after
        if moved < 1e-9:
            break
    return now


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The measures, a column of votes for each rule, ``posterior``, ``base_failed`` and ``kept`` for every document."""
    stage = Stage(docs.sparkSession)
    votes = rules()
    rows = stage.keep(measures(docs, id_col, text_col).withColumns(votes))
    counted = rows.filter("n_words > 0").groupBy(*votes).count().collect()  # at most 3 to the number of rules
    found = estimate([(tuple(r[n] for n in votes), r["count"]) for r in counted], list(votes))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = rows.withColumns({"posterior": found.posterior(), "base_failed": failed})
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
