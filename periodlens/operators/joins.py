"""Joins of a fact to a dimension.

Only a literal table, whose size is known by construction, carries a broadcast hint.
Every other join is left to the planner and AQE, which see real sizes: the plan is
the same expression at every scale, and nothing is broadcast on a guess. Facts are
pre-aggregated before they meet a dimension (see :mod:`periodlens.operators.facts`),
so a shuffle for such a join carries partial sums, not the raw feed.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner", literal: bool = False
) -> DataFrame:
    """Join ``fact`` to ``dim``. ``literal`` states that ``dim`` is a table of literal
    rows (or derived from one without growing), and only then is it broadcast."""
    return fact.join(F.broadcast(dim) if literal else dim, on, how)
