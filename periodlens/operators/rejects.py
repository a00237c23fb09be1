"""Rejected rows with their reason (Q1, S1, S2): one parse tells accepted rows from rejected ones.

A :class:`Rule` names what is wrong with a row. :func:`with_reason` adds the first rule that a row breaks (NULL: accepted);
:func:`write_split` writes both kinds in one job, apart at the write (``status=accepted`` / ``status=rejected``), and
counts the rows per reason in that same job.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import strict_date, try_integer, try_number
from .ingest import PEOPLE_DATE, PEOPLE_DATE_FORMAT, PEOPLE_HOUR, PEOPLE_TOTAL, PEOPLE_UNIT
from .metrics import free_names

ACCEPTED, REJECTED = "accepted", "rejected"


@dataclass(frozen=True)
class Rule:
    """``broken`` holds for the rows that ``name`` rejects; NULL counts as not broken."""

    name: str
    broken: Column


def people_rules() -> list[Rule]:
    """What makes a row of the population feed useless, most basic first. Blank cells are missing."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    hour = try_integer(PEOPLE_HOUR, "int")
    return [
        Rule("no date", blank(PEOPLE_DATE)),
        Rule("bad date", strict_date(PEOPLE_DATE, PEOPLE_DATE_FORMAT).isNull()),
        Rule("no hour", blank(PEOPLE_HOUR)),
        Rule("bad hour", hour.isNull() | ~hour.between(0, 23)),
        Rule("no unit", blank(PEOPLE_UNIT)),
        Rule("bad total", ~blank(PEOPLE_TOTAL) & try_number(PEOPLE_TOTAL, "double").isNull()),
    ]


def with_reason(df: DataFrame, rules: Sequence[Rule], name: str = "reason") -> DataFrame:
    """Add the name of the first rule each row breaks."""
    if name in df.columns:
        raise ValueError(f"the rows have a column {name!r}")
    return df.withColumn(name, F.coalesce(*[F.when(r.broken, F.lit(r.name)) for r in rules], F.lit(None).cast("string")))


def write_split(checked: DataFrame, rules: Sequence[Rule], path: str, reason: str = "reason") -> dict[str, int]:
    """Write accepted and rejected rows apart, in one job; returns the rows per reason (and ``accepted``)."""
    (status,) = free_names(checked, "status")
    if status != "status":
        raise ValueError("the rows have a column 'status'")
    seen = Observation()
    counts = [F.count_if(F.col(reason).isNull()).alias("n"), *[F.count_if(F.col(reason) == r.name).alias(f"n{i}") for i, r in enumerate(rules)]]
    rows = checked.observe(seen, *counts).withColumn("status", F.when(F.col(reason).isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)))
    rows.write.mode("overwrite").partitionBy("status").parquet(path)
    found = seen.get
    return {ACCEPTED: int(found["n"])} | {r.name: int(found[f"n{i}"]) for i, r in enumerate(rules)}


def read_split(spark: SparkSession, path: str, status: str, like: DataFrame) -> DataFrame:
    """The accepted or the rejected rows (with their reason) that :func:`write_split` wrote for a frame like this."""
    rows = spark.read.schema(like.schema.add("status", "string")).parquet(path).filter(F.col("status") == status).drop("status")
    return rows if status == REJECTED else rows.drop(*[c for c in rows.columns if c == "reason"])
