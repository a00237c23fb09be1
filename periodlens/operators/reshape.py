"""Wide <-> long reshaping of per-hour columns."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_to_rows(
    df: DataFrame,
    ids: Sequence[Column | str],
    columns: Sequence[tuple[int, str]],
    key: str = "hour",
    value: str = "value",
    parse=None,
) -> DataFrame:
    """One output row per (input row, listed column): ``ids..., key, value``.

    ``columns`` pairs a key literal with a column name, e.g. ``(18, "18시")``.
    ``parse`` maps the raw cell Column to the value (default: unchanged). The
    reshaping is a single ``inline(array(struct))`` generator in the scan's
    stage: no shuffle, no join to a key table.
    """
    parse = parse or (lambda c: c)
    cells = F.array(*[F.struct(F.lit(k).alias(key), parse(F.col(c)).alias(value)) for k, c in columns])
    return df.select(*ids, F.inline(cells))


def rows_to_columns(
    df: DataFrame, ids: Sequence[str], key: str, value: str, keys: Sequence[int], name_fmt: str = "h{key:02d}"
) -> DataFrame:
    """Pivot ``key`` values into columns (SUM of ``value``), with the key list given
    so Spark does not need a pass to discover it."""
    return df.groupBy(*ids).pivot(key, list(keys)).agg(F.sum(value)).select(
        *ids, *[F.col(str(k)).alias(name_fmt.format(key=k)) for k in keys]
    )
