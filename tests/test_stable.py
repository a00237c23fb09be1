"""Sums of doubles that don't depend on the order of the rows."""

import math
import random
import struct

import pytest
from pyspark.sql import functions as F

from periodlens.functions.stable import STABLE, stable_avg, stable_sum
from periodlens.operators.facts import Measure


def bits(x):
    return None if x is None else struct.pack(">d", x)


def values(seed, n=3000):
    rng = random.Random(seed)
    out = [rng.uniform(-1, 1) * 10 ** rng.randrange(-12, 13) for _ in range(n)]
    out += [0.1] * 500 + [-x for x in out[:400]] + [1e15, 1.0, -1e15, 0.0, -0.0, 2.0**-100]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_same_bits_under_any_dealing(spark, seed):
    xs = values(seed)
    rows = list(enumerate(xs))
    seen = set()
    for parts in (1, 7, 211):
        random.Random(parts).shuffle(rows)
        df = spark.createDataFrame(rows, "i long, x double").repartition(parts, "i")
        total, mean = df.agg(stable_sum("x"), stable_avg("x")).first()
        # partial sums per group first, then their sum: as a fact is built
        steps = df.groupBy((F.col("i") % 13).alias("g")).agg(stable_sum("x").alias("x")).agg(stable_sum("x")).first()[0]
        seen.add((bits(total), bits(mean), bits(steps)))
    assert len(seen) == 1
    exact = math.fsum(xs)
    assert math.isclose(total, exact, rel_tol=2.0**-50) and math.isclose(mean, exact / len(xs), rel_tol=2.0**-50)


def test_nulls_and_special_values(spark):
    def total(*xs):
        return spark.createDataFrame([(x,) for x in xs], "x double").agg(stable_sum("x")).first()[0]

    inf = math.inf
    assert total() is None and total(None) is None
    assert total(1.5, None, 2.5) == 4.0
    assert total(inf, 1.0) == inf and total(-inf, 1.0) == -inf
    assert math.isnan(total(inf, -inf)) and math.isnan(total(math.nan, 1.0))


@pytest.mark.parametrize("x", [1e300, 1e-300, 2.0**-121])
def test_values_beyond_the_bins_are_an_error(spark, x):
    with pytest.raises(Exception, match="outside the bins"):
        spark.createDataFrame([(x,), (1.0,)], "x double").agg(stable_sum("x")).collect()
    wide = (0, 41) if x > 1 else (-40, 1)
    if x > 1e-200:
        assert spark.createDataFrame([(x,)], "x double").agg(stable_sum("x", wide)).first()[0] == x


def test_measure(spark):
    m = Measure("x", STABLE)
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (2, 0.3), (2, None)], "g int, x double")
    assert df.groupBy("g").agg(m.partial()).agg(m.total()).first()["x"] == math.fsum([0.1 + 0.2, 0.3])
