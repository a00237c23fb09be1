"""Reports over lattices equal the reports over the facts; a job scans each fact once."""

import pytest
from pyspark.sql import functions as F

from periodlens.operators.lattice import MEASURES, Lattice, lattice
from periodlens.operators.metrics import ranked
from periodlens.plans import catalog, pipelines
from periodlens.plans.reports import REPORTS
from periodlens.session import staging_path
from periodlens.sources import testdata as td

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark):
    base = staging_path(spark, "facts")
    pop, rid = catalog.event_facts(spark, SF_SMALL)
    pop.write.parquet(f"{base}/pop")
    rid.write.parquet(f"{base}/rid")
    return f"{base}/pop", f"{base}/rid"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_report_over_lattices_equals_report_over_facts(spark, written, name):
    pop, rid = (spark.read.parquet(p) for p in written)
    lattices = [lattice(f, MEASURES[t], scales=td.MEASURE_SCALES) for f, t in ((pop, "area_population"), (rid, "area_subway"))]
    assert rows(catalog.rounded(REPORTS[name].build(*lattices, scales=td.MEASURE_SCALES))) == rows(catalog.rounded(REPORTS[name].build(pop, rid, scales=td.MEASURE_SCALES)))


def test_report_job_scans_each_fact_once(spark, written):
    out = pipelines.report_job(spark, *written, scales=td.MEASURE_SCALES)
    assert set(out) == set(REPORTS)
    for df in out.values():
        files = df.inputFiles()
        assert files and not any("/pop/" in f or "/rid/" in f for f in files)


def test_lattice_is_made_for_its_scales(spark, written):
    made = lattice(spark.read.parquet(written[0]), MEASURES["area_population"])
    assert isinstance(made, Lattice)
    with pytest.raises(ValueError, match="scale"):
        REPORTS["population_phase_change"].build(made, None, scales=td.MEASURE_SCALES)
    assert REPORTS["population_phase_change"].build(made, None).count() > 0


def test_ranked_keeps_columns_of_clashing_names(spark):
    df = spark.range(40).select((F.col("id") % 3).alias("area_id"), F.col("id").alias("_range"), F.lit("x").alias("_local"), F.lit(1).alias("_KEY_0"), F.lit(2).alias("_offset"), F.col("id").alias("v"))
    got = ranked(df, ["area_id"], "v", tiebreak=["_range"], method="range", num_ranges=5)
    assert rows(got.drop("rank_no")) == rows(df)
    assert rows(got) == rows(ranked(df, ["area_id"], "v", tiebreak=["_range"]))
