"""Reusable report operators over a fact.

All of them are one aggregation (partial + final hash aggregate, so a hot key is
pre-combined on the map side) or a window over an already aggregated, small
frame. None joins facts to facts: joins happen only between aggregates.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import did_lift, lift, to_units
from ..session import staging_path
from ..sources.dimensions import CONTROL_AREA_TYPES, TREATMENT_AREA_TYPES
from .lattice import Source, mean


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_avg(measure: Column | str, scale: int | None = None) -> Column:
    """AVG of ``measure``. With ``scale`` (values recorded with that many decimals)
    the sum is taken exactly in integer units: (sum of units / count) / 10^scale,
    so the result does not depend on the order the rows are summed in."""
    if scale is None:
        return F.avg(_c(measure))
    x = _c(measure)
    return F.sum(to_units(x, scale)) / F.count(x) / float(10**scale)


def conditional_avg(measure: Column | str, condition: Column, scale: int | None = None) -> Column:
    """AVG over the rows where ``condition`` holds (A3): AVG(CASE WHEN c THEN x END)."""
    return exact_avg(F.when(condition, _c(measure)), scale)


def period_rows(fact: Source, phases: Iterable[str], require_semester: bool = True) -> Source:
    """Rows of the listed phases (F4), with a semester (F5). Both predicates reach a
    Parquet scan as pushed filters."""
    cond = F.col("phase").isin(*phases)
    if require_semester:
        cond = cond & F.col("semester").isNotNull()
    return fact.filter(cond)


def phase_avg(
    fact: Source,
    keys: Sequence[str],
    outputs: Sequence[tuple[str, str, str]],
    require_semester: bool = True,
    scales: dict[str, int] | None = None,
) -> DataFrame:
    """Phase pivot (A3-A12): for each ``(name, measure, phase)`` the AVG of
    ``measure`` over the rows in ``phase``, grouped by ``keys``, in one pass.
    ``scales`` gives the decimal scale of measures to average exactly."""
    scales = scales or {}
    phases = sorted({p for _, _, p in outputs})
    rows = period_rows(fact, phases, require_semester)
    if len(phases) == 1:
        aggs = [mean(rows, m, None, scales.get(m)).alias(n) for n, m, _ in outputs]
    else:
        aggs = [mean(rows, m, F.col("phase") == p, scales.get(m)).alias(n) for n, m, p in outputs]
    return rows.groupBy(*keys).agg(*aggs)


def with_lifts(df: DataFrame, lifts: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Append ``(name, base, new)`` lift columns."""
    return df.select("*", *[lift(b, n).alias(name) for name, b, n in lifts])


def ranked(
    df: DataFrame,
    partition: Sequence[str],
    order: str,
    name: str = "rank_no",
    tiebreak: Sequence[str] = ("area_id",),
    method: str = "window",
    num_ranges: int | None = None,
) -> DataFrame:
    """ROW_NUMBER per ``partition`` by ``order`` DESC NULLS LAST.

    ``tiebreak`` columns make the numbering deterministic for equal values.

    ``method="window"`` (used by the reports) is one window: every row of a
    group is numbered in one task, which suits report aggregates, whose size is
    bounded by the number of areas. ``method="range"`` numbers a frame of any size
    without sending a group to one task: the rows are range-partitioned on the
    full sort key (a large group spans several ranges) and written once to shared
    storage with their range, then numbered within each (group, range) and shifted
    by the row counts of the group's earlier ranges. Both branches read what was
    written, so they see the same ranges. NULL keys are groups like any other.
    """
    sort = [F.col(order).desc_nulls_last(), *[F.col(t).asc() for t in tiebreak]]
    if method == "window":
        w = Window.partitionBy(*partition).orderBy(*sort)
        return df.withColumn(name, F.row_number().over(w).cast("bigint"))
    if method != "range":
        raise ValueError("method must be 'window' or 'range'")
    spark = df.sparkSession
    ranges = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, local_rank, offset, rows = free_names(df, "_range", "_local", "_offset", "_rows")
    path = staging_path(spark, "ranked")
    df.repartitionByRange(ranges, *[F.col(p).asc() for p in partition], *sort).withColumn(
        part, F.spark_partition_id()
    ).write.parquet(path)
    spread = spark.read.parquet(path)
    local = spread.withColumn(local_rank, F.row_number().over(Window.partitionBy(*partition, part).orderBy(*sort)))
    counts = spread.groupBy(*partition, part).agg(F.count(F.lit(1)).alias(rows))
    before = Window.partitionBy(*partition).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    keys = free_names(df, *[f"_key_{i}" for i in range(len(partition) + 1)])
    offsets = counts.select(
        *[F.col(p).alias(k) for k, p in zip(keys, partition)], F.col(part).alias(keys[-1]),
        F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(offset),
    )
    same = [F.col(p).eqNullSafe(F.col(k)) for k, p in zip(keys, partition)]
    joined = local.join(offsets, reduce(lambda a, b: a & b, [F.col(part) == F.col(keys[-1]), *same]))
    return joined.select(*df.columns, (F.col(local_rank) + F.col(offset)).cast("bigint").alias(name))


def top_k_per_group(df: DataFrame, partition: Sequence[str], order: Sequence[Column], k: int, name: str = "rank_no") -> DataFrame:
    """The first ``k`` rows of each group (W1, W3, O3), numbered from 1.

    The filter stands on the row number, so the planner keeps ``k`` rows a group in every task before
    the shuffle (a window group limit): what a group brings to its task is bounded by k times the tasks, however many
    rows it has. ``order`` should be total, or ties are numbered in any order."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w).cast("long")).filter(F.col(name) <= k)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def group_phase_avg(
    fact: Source,
    keys: Sequence[str],
    measure: str,
    groups: dict[str, Sequence[str]],
    phases: Sequence[str] = ("before", "after"),
    group_col: str = "area_type",
    name_fmt: str = "{group}_{phase}",
    scale: int | None = None,
) -> DataFrame:
    """Group x phase pivot (A13, A14): AVG of ``measure`` for each (group, phase),
    only over rows whose ``group_col`` is in one of the groups (F6)."""
    members = sorted({v for vs in groups.values() for v in vs})
    rows = period_rows(fact, phases).filter(F.col(group_col).isin(*members))
    aggs = [
        mean(rows, measure, F.col(group_col).isin(*vals) & (F.col("phase") == p), scale).alias(
            name_fmt.format(group=g, phase=p)
        )
        for g, vals in groups.items()
        for p in phases
    ]
    return rows.groupBy(*keys).agg(*aggs)


def did(
    fact: Source,
    measure: str,
    suffix: str,
    keys: Sequence[str] = ("semester", "exam_type"),
    treatment: Sequence[str] = TREATMENT_AREA_TYPES,
    control: Sequence[str] = CONTROL_AREA_TYPES,
    scale: int | None = None,
) -> DataFrame:
    """Difference in differences of the after-vs-before lift, treatment vs control
    (A13, A14, P14): one group x phase pivot, then the two lifts and their gap."""
    pivot = group_phase_avg(
        fact, keys, measure, {"treatment": treatment, "control": control},
        name_fmt="{group}_{phase}_" + suffix, scale=scale,
    )
    tb, ta = f"treatment_before_{suffix}", f"treatment_after_{suffix}"
    cb, ca = f"control_before_{suffix}", f"control_after_{suffix}"
    return pivot.select(
        *keys,
        tb,
        ta,
        lift(tb, ta).alias("treatment_lift"),
        cb,
        ca,
        lift(cb, ca).alias("control_lift"),
        did_lift(tb, ta, cb, ca).alias("did_lift"),
    )


def with_zscores(
    df: DataFrame, columns: dict[str, str], partition: Sequence[str], method: str = "window"
) -> DataFrame:
    """Append ``name = (x - mean) / population standard deviation`` within
    ``partition`` for each ``name: x`` of ``columns`` (X1); NULL when the deviation
    is 0 or undefined.

    ``method="window"`` (used by the reports) computes the statistics with a window
    in the same pass; each group is handled by one task, which suits report
    aggregates bounded by the number of areas. ``method="aggregate"`` takes the
    statistics from a ``groupBy`` (partially aggregated, so no group is gathered
    into one task) joined back on the partition keys; ``df`` is then read twice,
    so materialize a large ``df`` first (e.g. write it as a table).
    """
    if method == "window":
        w = Window.partitionBy(*partition)
        scores = []
        for n, x in columns.items():
            sd = F.stddev_pop(x).over(w)
            scores.append(F.when(sd > 0, (F.col(x) - F.avg(x).over(w)) / sd).alias(n))
        return df.select("*", *scores)
    if method != "aggregate":
        raise ValueError("method must be 'window' or 'aggregate'")
    stats = df.groupBy(*partition).agg(
        *[F.avg(x).alias(f"_mean_{n}") for n, x in columns.items()],
        *[F.stddev_pop(x).alias(f"_sd_{n}") for n, x in columns.items()],
    )
    keyed = stats.select(*[F.col(p).alias(f"_key_{i}") for i, p in enumerate(partition)], *stats.columns[len(partition):])
    same = [F.col(p).eqNullSafe(F.col(f"_key_{i}")) for i, p in enumerate(partition)]
    joined = df.join(keyed, reduce(lambda a, b: a & b, same), "left")
    scores = [
        F.when(F.col(f"_sd_{n}") > 0, (F.col(x) - F.col(f"_mean_{n}")) / F.col(f"_sd_{n}")).alias(n)
        for n, x in columns.items()
    ]
    return joined.select(*df.columns, *scores)
