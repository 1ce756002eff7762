"""Text repair."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.frames import string_columns


def strip_prefix(value: Column, prefix: str) -> Column:
    tail = F.substring(value, F.lit(len(prefix) + 1), F.length(value))
    return F.when(value.startswith(prefix), tail).otherwise(value)


def tail_from(value: Column, start: int) -> Column:
    """Characters from position ``start`` on; trailing blanks do not count towards the length."""
    return F.substring(value, F.lit(start), F.length(F.rtrim(value)))


def _plain(letter: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(c))


# Blocks of letters, ordinals, indices and wide forms used with Latin text.
_BLOCKS = ((0x00A0, 0x0250), (0x02B0, 0x0300), (0x1E00, 0x1F00), (0x2070, 0x20A0), (0xFB00, 0xFB07), (0xFF01, 0xFF5F))


def _latin_pairs() -> tuple[str, str, dict[str, str]]:
    """Letters whose decomposition is one letter plus marks, and those of several letters."""
    accented, plain, several = [], [], {}
    for point in (p for start, end in _BLOCKS for p in range(start, end)):
        letter = chr(point)
        base = _plain(letter)
        if len(base) == 1 and base != letter:
            accented.append(letter)
            plain.append(base)
        elif len(base) > 1:
            several[letter] = base
    return "".join(accented), "".join(plain), several


_ACCENTED, _PLAIN, _SEVERAL = _latin_pairs()
_MARKS = "".join(chr(p) for p in range(0x0300, 0x0370) if unicodedata.combining(chr(p)))


def strip_accents(value: Column) -> Column:
    """Plain letters for accented Latin ones, ordinals, ligatures and fractions, without leaving the JVM."""
    single = F.translate(value, _ACCENTED + _MARKS, _PLAIN)
    whole = single
    for letter, base in _SEVERAL.items():
        whole = F.replace(whole, F.lit(letter), F.lit(base))
    return F.when(single.rlike("[" + "".join(_SEVERAL) + "]"), whole).otherwise(single)


@F.pandas_udf(T.StringType())
def _decomposed(values: pd.Series) -> pd.Series:
    def plain(text):
        if text is None or text.isascii():
            return text
        return _plain(text)

    return values.map(plain)


def strip_accents_any_script(value: Column) -> Column:
    """Compatibility decomposition with marks removed, for text of any script (Arrow batches)."""
    return _decomposed(value)


def strip_accents_everywhere(df: DataFrame, any_script: bool = False) -> DataFrame:
    change = strip_accents_any_script if any_script else strip_accents
    return df.withColumns({name: change(F.col(name)) for name in string_columns(df)})


def blank_to_null(value: Column, sentinels: tuple[str, ...] = ("*", "N/D")) -> Column:
    """NULL for markers of withheld data."""
    return F.when(~value.isin(*sentinels), value)


# Fixed pattern: degrees, minutes, seconds and a compass letter, signs optional.
_ANGLE = r"""(?i)^\s*(\d+)[°\s]*(\d+)['\s]*([\d.]+)["\s]*([NSWE])\s*$"""


def degrees_from_dms(value: Column, digits: int = 4) -> Column:
    """Decimal degrees of a text such as 111°40'24.022" W; NULL when it does not read as an angle."""
    part = [F.regexp_extract(value, _ANGLE, i) for i in range(1, 5)]
    size = reduce(
        lambda total, scaled: total + scaled,
        [p.try_cast("double") / F.lit(unit) for p, unit in zip(part[:3], (1.0, 60.0, 3600.0))],
    )
    signed = F.when(F.upper(part[3]).isin("S", "W"), -size).otherwise(size)
    return F.when(value.rlike(_ANGLE), F.round(signed, digits))
