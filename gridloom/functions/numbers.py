"""Rounding and numerals."""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERAL = r"\d+(?:\.\d+)?"


def rint(x: Column, places: int = 0) -> Column:
    """Half to even on the scaled value; the same in every engine that rounds doubles so."""
    scale = 10.0**places
    return F.rint(x * scale) / scale if places else F.rint(x)


def exact_round(places: int):
    """Rounding of the exact binary value, as Python's round() does, for a column of doubles."""
    @F.pandas_udf("double")
    def rounded(x: pd.Series) -> pd.Series:
        return x.map(lambda v: None if v is None or v != v else float(round(v, places)))

    return rounded


def normalised_numeral(value: Column) -> Column:
    """1, 1.0 and 1.00 are one number; others keep six places. All digits are those of the exact binary value, as C's printf
    writes them: Spark's format_string rounds the shortest decimal instead, and its floor ends at 2 ** 63."""
    @F.pandas_udf("string")
    def written(x: pd.Series) -> pd.Series:
        return pd.Series([None if v != v else f"{v:.0f}" if v.is_integer() else f"{v:.6f}".rstrip("0") for v in x.tolist()], dtype=object)

    return written(value.cast("double"))


def numerals(text: Column) -> Column:
    """The distinct numerals of a text, as numbers; signs aren't part of them."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(NUMERAL), F.lit(0))
    return F.array_distinct(F.transform(found, lambda t: t.cast("double")))


def plain_numeral(value: float | str) -> str:
    number = float(value)
    return str(int(number)) if math.isfinite(number) and number == int(number) else str(round(number, 6))


def numerals_of(node: object) -> set[str]:
    """Every number anywhere in nested data: keys, values and inside strings; truth values aren't numbers."""
    todo, found = [node], set()
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            todo += [*x.keys(), *x.values()]
        elif isinstance(x, (list, tuple)):
            todo += x
        elif isinstance(x, str):
            found |= {plain_numeral(m) for m in re.findall(NUMERAL, x)}
        elif isinstance(x, (int, float)) and not isinstance(x, bool):
            found |= {plain_numeral(str(abs(x)))}  # the expression above drops signs, so signs don't count here
    return found


def bucket(x: Column, floors: list[tuple[float, str]]) -> Column:
    """The word of the highest floor that x reaches, or the last word."""
    out = F.lit(floors[-1][1])
    for floor, word in sorted(floors):
        out = F.when(x >= floor, word).otherwise(out)
    return out
