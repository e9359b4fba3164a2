"""Colours of scores, classes and stretched bands, as arrays of red, green and blue."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stops, the excluded colour and the class palette.
EXCLUDED = (38, 38, 42)
RAMP = ((0, (158, 44, 44)), (35, (196, 118, 44)), (60, (206, 186, 62)), (80, (118, 168, 68)), (100, (38, 116, 62)))
PALETTE = {0: (0, 0, 0), 1: (26, 92, 45), 2: (163, 186, 72), 3: (232, 178, 92), 4: (198, 62, 48), 5: (176, 168, 148), 6: (44, 102, 194)}


def _rgb(values: tuple[int, int, int]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def score_rgb(score: Column) -> Column:
    """Excluded pixels are grey, others run through the ramp; fractions are cut off, and scores over 100 count as 100."""
    x = F.least(score, F.lit(100))
    out = _rgb(RAMP[-1][1])
    for (lo, a), (hi, b) in reversed(list(zip(RAMP, RAMP[1:], strict=False))):
        mixed = F.array(*[(p + (q - p) * (x - lo) / float(hi - lo)).cast("int") for p, q in zip(a, b, strict=True)])
        out = F.when(x < hi, mixed).otherwise(out)
    return F.when(score == 0, _rgb(EXCLUDED)).otherwise(out)


def class_rgb(code: Column) -> Column:
    table = F.create_map(*[x for k, v in PALETTE.items() for x in (F.lit(k), _rgb(v))])
    return F.coalesce(F.try_element_at(table, code.cast("int")), _rgb((0, 0, 0)))


def stretched(value: Column, low: Column, high: Column) -> Column:
    """0 to 255 between low and high, cut off to whole numbers; missing values are 0, and a flat band has a span of one."""
    top = F.when(high <= low, low + 1).otherwise(high)
    return F.coalesce(F.least(F.lit(255.0), F.greatest(F.lit(0.0), (value - low) / (top - low) * 255)), F.lit(0.0)).cast("int")
