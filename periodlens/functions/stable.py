"""Sums of doubles whose bits don't depend on the order of the rows (A1, A3, X1), for measures without a stated scale.

A double is split into whole numbers of fixed powers of two (bins of ``BIN`` bits): x = sum of c_b * 2**(BIN * b), where each
c_b is an integer of at most 2**(BIN - 1). Integers add up exactly in any order, partial sums included, so the bins'
totals are the same however the rows are dealt out, and so is the double that is put together from them, in one fixed
order. Everything is built-in expressions: a bin is a rounded quotient by a power of two, less what the next bin holds.

The default bins hold values below 2**119 that are multiples of 2**-120; a value beyond them is an error, never a rounded
sum. Other bins can be given (42 of them at most). Up to 2**40 rows a group fit. NaN and infinities give what a plain sum gives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BIN = 24
#: lowest and highest bin
BINS = (-5, 4)
#: stands for a measure's number of decimals where it has none: its sums are taken this way
STABLE = "stable"


def _parts(x: Column, bins: tuple[int, int]) -> list[tuple[int, Column]]:
    low, high = bins
    whole = {b: F.rint(x * 2.0 ** (-BIN * b)) for b in range(low, high + 2)}
    parts = []
    for b in range(low, high + 1):
        part = (whole[b] - whole[b + 1] * 2.0**BIN).try_cast("long")
        if b == low:  # what the bins can't hold
            fits = (whole[low] * 2.0 ** (BIN * low) == x) & (whole[high + 1] == 0)
            message = F.concat(F.lit(f"outside the bins {low}..{high} of a stable sum: "), x.cast("string"))
            part = F.when(fits | x.isNull(), part).otherwise(F.raise_error(message).cast("long"))
        parts.append((b, part))
    return parts


def stable_sum(value: Column | str, bins: tuple[int, int] = BINS) -> Column:
    """SUM of a double, the same bits in any order of the rows; NULL over no values."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    infinite = float("inf")
    finite = F.when(~F.isnan(x) & (x != infinite) & (x != -infinite), x)
    totals = [F.sum(part).cast("double") * 2.0 ** (BIN * b) for b, part in _parts(finite, bins)]
    # from the highest bin down
    total = reduce(lambda a, b: a + b, totals[::-1])
    seen = lambda condition: F.coalesce(F.max(condition), F.lit(False))
    up, down = seen(x == infinite), seen(x == -infinite)
    special = F.when(seen(F.isnan(x)) | (up & down), F.lit(float("nan"))).when(up, F.lit(infinite)).when(down, F.lit(-infinite))
    return F.when(F.count(x) > 0, F.coalesce(special, total))


def stable_avg(value: Column | str, bins: tuple[int, int] = BINS) -> Column:
    """AVG of a double from its stable sum."""
    x = F.col(value) if isinstance(value, str) else value
    return F.when(F.count(x) > 0, stable_sum(x, bins) / F.count(x))
