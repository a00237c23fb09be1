"""Benchmark: the fact builds and the report catalog on the test tables.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3). Two warm-up passes over the whole set, then BENCH_RUNS timed rounds that each begin at
another query; a query's figure is its median. Results go to the ``noop`` sink so every row is produced. Extra entries
compare design choices (day-expanded vs range-join period labelling; all reports
over facts persisted once to Parquet, the production shape) and time each
operator-level catalog entry once after a warm-up (BENCH_OPERATORS=0 skips them).

Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from periodlens.plans import catalog, catalog_ops  # noqa: E402
from periodlens.plans.pipelines import staged_lattice  # noqa: E402
from periodlens.plans.reports import REPORTS  # noqa: E402
from periodlens.session import local_session, staging_path  # noqa: E402


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    samples = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        samples.append(time.perf_counter() - t0)
    return round(statistics.median(samples), 3)


def _sf(sf_dir: str):
    name = os.path.basename(sf_dir).replace("sf", "")
    try:
        return float(name)
    except ValueError:
        return name


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="periodlens-bench")

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    # two warm-up passes over the whole set first, so the queries timed first do not pay for JVM class loading and JIT
    # compilation of the others; then rounds that each begin at another query, so no query is always timed first
    names = list(catalog.QUERIES)
    for _ in range(2):
        for fn in catalog.QUERIES.values():
            noop(fn(spark, sf_dir))

    samples: dict[str, list[float]] = {name: [] for name in names}
    for i in range(runs):
        start = i * len(names) // runs
        for name in names[start:] + names[:start]:
            t0 = time.perf_counter()
            noop(catalog.QUERIES[name](spark, sf_dir))
            samples[name].append(time.perf_counter() - t0)
    results = {name: round(statistics.median(x), 3) for name, x in samples.items()}
    headline = round(sum(results.values()), 3)

    extras: dict[str, float] = {}
    for strategy in ("expanded", "range"):
        extras[f"fact_population_{strategy}_join"] = timed(
            lambda strategy=strategy: noop(catalog.event_population_fact(spark, sf_dir, strategy=strategy)), runs
        )

    def persisted():
        base = staging_path(spark, "bench-facts")
        catalog.event_population_fact(spark, sf_dir).write.mode("overwrite").parquet(f"{base}/population")
        catalog.event_ridership_fact(spark, sf_dir).write.mode("overwrite").parquet(f"{base}/ridership")
        # as report_job does: one scan of each fact, all reports fold its lattice
        pop = staged_lattice(spark, spark.read.parquet(f"{base}/population"), "area_population")
        rid = staged_lattice(spark, spark.read.parquet(f"{base}/ridership"), "area_subway")
        for r in REPORTS.values():
            noop(r.build(pop, rid))

    extras["all_reports_over_persisted_facts"] = timed(persisted, runs)

    operators: dict[str, float] = {}
    if os.environ.get("BENCH_OPERATORS", "1") == "1":
        for name, fn in catalog_ops.QUERIES.items():
            operators[name] = timed(lambda fn=fn: noop(fn(spark, sf_dir)), 1)

    print(
        json.dumps(
            {
                "metric": "catalog_total_median_sec",
                "value": headline,
                "unit": "sec",
                "queries": results,
                "extras": extras,
                "operators": operators,
                "sf": _sf(sf_dir),
                "cpus": cpus,
                "runs": runs,
                "machine": {"cores": os.cpu_count(), "python": platform.python_version(), "spark": spark.version},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
