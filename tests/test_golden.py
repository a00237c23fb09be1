"""End-to-end golden fixture: raw CSVs -> facts -> reports, expected values
computed by hand (see FIXTURES.md section 2)."""

import pytest

from periodlens.plans import pipelines
from periodlens.plans.reports import REPORTS
from periodlens.sources.dimensions import write_dimension_csvs

PEOPLE_HEADER = "기준일ID,시간대구분,행정동코드,총생활인구수,남자20세부터24세생활인구수,남자25세부터29세생활인구수,여자20세부터24세생활인구수,여자25세부터29세생활인구수"
PEOPLE_ROWS = [
    "20250414,18,11440660,100,10,10,10,10",
    "20250414,18,11440680,50,*,5,5,5",
    "20250501,18,11440660,300,30,30,30,30",
    "20250414,18,11410585,200,20,20,20,20",
    "20250501,18,11410585,100,20,20,20,0",
    "20250414,12,11440660,999,9,9,9,9",
    "20250431,18,11440660,999,9,9,9,9",
    "20250301,18,11440660,120,10,10,10,20",
    "20250414,18,99999999,999,9,9,9,9",
]
SUBWAY_HEADER = "수송일자,호선명,역명,승하차구분,승객유형,18시,19시,20시,21시,22시,23시,00시,01시,02시"
SUBWAY_ROWS = [
    '2025-04-14,2호선,홍대입구,하차,일반,"1,000",,,,,,,,',
    "2025-04-14,2호선,홍대입구,승차,일반,700,,,,,,,,",
    "2025-05-01,2호선,홍대입구, 하차 ,일반,550,,,,,,,,",
    "2025-04-14,2호선,신촌,하차,일반,400,,,,,,,,",
    "2025-04-14,2호선,이대,하차,일반,100,,,,,,,,",
    "2025-05-01,2호선,신촌,하차,일반,600,,,,,,,,",
    "2025-05-01,2호선,없는역,하차,일반,999,,,,,,,,",
]


@pytest.fixture(scope="module")
def facts(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("golden")
    (root / "people").mkdir()
    (root / "subway").mkdir()
    (root / "people" / "p1.csv").write_bytes(("\ufeff" + "\n".join([PEOPLE_HEADER, *PEOPLE_ROWS]) + "\n").encode("utf-8"))
    (root / "subway" / "s1.csv").write_bytes(("\n".join([SUBWAY_HEADER, *SUBWAY_ROWS]) + "\n").encode("cp949"))
    dims = write_dimension_csvs(spark, str(root / "dims"))
    pipelines.population_job(spark, str(root / "people"), dims["area_mapping"], dims["exam_periods"], str(root / "pop"))
    counts = pipelines.ridership_job(spark, str(root / "subway"), dims["area_mapping"], dims["exam_periods"], str(root / "rid"))
    pop = spark.read.parquet(str(root / "pop"))
    rid = spark.read.parquet(str(root / "rid"))
    return pop, rid, counts


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def approx(v, n=6):
    return None if v is None else round(v, n)


def test_population_fact(facts):
    pop, _, _ = facts
    got = rows(pop, "area_id", "phase", "exam_type", "semester", "total_population", "young_20s_population")
    assert got == [
        ("hongdae", "after", "midterm", 1, 300.0, 120.0),
        ("hongdae", "before", "midterm", 1, 150.0, 55.0),
        ("hongdae", "normal", "normal", None, 120.0, 50.0),
        ("shinchon", "after", "midterm", 1, 100.0, 60.0),
        ("shinchon", "before", "midterm", 1, 200.0, 80.0),
    ]
    ratios = {(r["area_id"], r["phase"]): approx(r["young_20s_ratio"]) for r in pop.collect()}
    assert ratios[("hongdae", "before")] == 0.366667
    assert ratios[("shinchon", "after")] == 0.6
    first = pop.filter("area_id = 'hongdae' AND phase = 'before'").first()
    assert (first["day_of_week"], first["day_of_week_num"], first["is_weekend"], first["time_band"]) == ("Mon", 2, False, "evening")
    normal = pop.filter("phase = 'normal'").first()
    assert (normal["day_of_week"], normal["is_weekend"]) == ("Sat", True)


def test_ridership_fact(facts):
    _, rid, counts = facts
    assert rows(rid, "area_id", "phase", "alighting_count") == [
        ("hongdae", "after", 550),
        ("hongdae", "before", 1000),
        ("shinchon", "after", 600),
        ("shinchon", "before", 500),
    ]
    assert all(n > 0 for n in counts.values())


def report(facts, name):
    pop, rid, _ = facts
    return REPORTS[name].build(pop, rid)


def test_r1(facts):
    got = {r["area_id"]: (r["before_population"], r["during_population"], r["after_population"], r["during_lift"], r["after_lift"])
           for r in report(facts, "population_phase_change").collect()}
    assert got == {"hongdae": (150.0, None, 300.0, None, 1.0), "shinchon": (200.0, None, 100.0, None, -0.5)}


def test_r2_r3(facts):
    r2 = {r["area_id"]: (r["before_young_population"], r["after_young_population"], approx(r["young_after_lift"]), r["rank_no"])
          for r in report(facts, "young_population_lift").collect()}
    assert r2 == {"hongdae": (55.0, 120.0, 1.181818, 1), "shinchon": (80.0, 60.0, -0.25, 2)}
    r3 = {r["area_id"]: (r["before_alighting"], r["after_alighting"], approx(r["alighting_after_lift"]), r["rank_no"])
          for r in report(facts, "subway_alighting_lift").collect()}
    assert r3 == {"hongdae": (1000.0, 550.0, -0.45, 2), "shinchon": (500.0, 600.0, 0.2, 1)}


def test_r4(facts):
    got = {r["area_id"]: (r["population_rank"], r["subway_rank"], r["rank_gap"]) for r in report(facts, "hotplace_rank_compare").collect()}
    assert got == {"hongdae": (1, 2, -1), "shinchon": (2, 1, 1)}


def test_r5_r6_r7(facts):
    r5 = {r["area_type"]: (r["before_population"], r["after_population"], approx(r["population_after_lift"]),
                           r["before_young_population"], r["after_young_population"], approx(r["young_after_lift"]),
                           r["before_alighting"], r["after_alighting"], approx(r["alighting_after_lift"]))
          for r in report(facts, "area_type_change").collect()}
    assert r5 == {
        "nightlife": (150.0, 300.0, 1.0, 55.0, 120.0, 1.181818, 1000.0, 550.0, -0.45),
        "university": (200.0, 100.0, -0.5, 80.0, 60.0, -0.25, 500.0, 600.0, 0.2),
    }
    r6 = {(r["area_id"], r["time_band"]): (approx(r["young_after_lift"]), r["rank_no"]) for r in report(facts, "time_band_young_lift").collect()}
    assert r6 == {("hongdae", "evening"): (1.181818, 1), ("shinchon", "evening"): (-0.25, 2)}
    r7 = {(r["area_id"], r["is_weekend"]): (approx(r["young_after_lift"]), approx(r["alighting_after_lift"]))
          for r in report(facts, "weekend_effect").collect()}
    assert r7 == {("hongdae", False): (1.181818, -0.45), ("shinchon", False): (-0.25, 0.2)}


def test_r8(facts):
    got = [(r["area_id"], r["normal_young_population"], r["after_young_population"], approx(r["young_after_vs_normal_lift"]),
            r["normal_total_population"], r["after_total_population"], approx(r["total_after_vs_normal_lift"]))
           for r in report(facts, "after_vs_normal").collect()]
    assert got == [("hongdae", 50.0, 120.0, 1.4, 120.0, 300.0, 1.5)]


def test_r9_r10(facts):
    r9 = report(facts, "did_young_population").first()
    assert (r9["treatment_before_young"], r9["treatment_after_young"], approx(r9["treatment_lift"])) == (80.0, 60.0, -0.25)
    assert (r9["control_before_young"], r9["control_after_young"], approx(r9["control_lift"])) == (55.0, 120.0, 1.181818)
    assert approx(r9["did_lift"]) == -1.431818
    r10 = report(facts, "did_subway_alighting").first()
    assert (r10["treatment_before_alighting"], r10["treatment_after_alighting"], approx(r10["treatment_lift"])) == (500.0, 600.0, 0.2)
    assert (r10["control_before_alighting"], r10["control_after_alighting"], approx(r10["control_lift"])) == (1000.0, 550.0, -0.45)
    assert approx(r10["did_lift"]) == 0.65


def test_report_job_exports(spark, facts, tmp_path):
    pop, rid, _ = facts
    pop.write.parquet(str(tmp_path / "pop"))
    rid.write.parquet(str(tmp_path / "rid"))
    db = f"golden_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path / 'warehouse'}'")
    out = pipelines.report_job(spark, str(tmp_path / "pop"), str(tmp_path / "rid"), str(tmp_path / "results"), database=db,
                               names=["young_population_lift", "population_phase_change"])
    text = "".join(p.read_text() for p in sorted((tmp_path / "results" / "young_population_lift").glob("part-*")))
    lines = text.strip().splitlines()
    assert lines[0].startswith("1,midterm,1,hongdae,")
    assert lines[1].startswith("1,midterm,2,shinchon,")
    r1 = "".join(p.read_text() for p in sorted((tmp_path / "results" / "population_phase_change").glob("part-*")))
    assert "\\N" in r1  # NULL during values are written as \N
    assert spark.table(f"{db}.result_young_population_lift").count() == 2
    assert set(out) == {"young_population_lift", "population_phase_change"}


def test_cli_jobs(spark, tmp_path):
    from periodlens import cli

    base = tmp_path / "base"
    (base / "raw" / "people").mkdir(parents=True)
    (base / "raw" / "subway").mkdir(parents=True)
    (base / "raw" / "people" / "p.csv").write_bytes(("\n".join([PEOPLE_HEADER, *PEOPLE_ROWS]) + "\n").encode("utf-8"))
    (base / "raw" / "subway" / "s.csv").write_bytes(("\n".join([SUBWAY_HEADER, *SUBWAY_ROWS]) + "\n").encode("cp949"))
    b = ["--base-dir", str(base)]
    assert cli.main([*b, "dimensions"]) == 0
    assert cli.main([*b, "population", "--partition-by", "year,month"]) == 0
    assert cli.main([*b, "ridership", "--encoding", "CP949", "--single-layout"]) == 0
    assert cli.main([*b, "reports", "--names", "did_subway_alighting", "--scales", "total_population=0"]) == 0
    text = "".join(p.read_text() for p in (base / "results" / "did_subway_alighting").glob("part-*"))
    assert text.startswith("1,midterm,500.0,600.0,0.2,1000.0,550.0,-0.45,0.65")


def test_failed_gate_keeps_previous_output(spark, tmp_path):
    from periodlens.operators.quality import EmptyStageError

    (tmp_path / "subway").mkdir()
    boarding_only = [r for r in SUBWAY_ROWS if "승차" in r]
    (tmp_path / "subway" / "s.csv").write_bytes(("\n".join([SUBWAY_HEADER, *boarding_only]) + "\n").encode("cp949"))
    dims = write_dimension_csvs(spark, str(tmp_path / "dims"))
    out = str(tmp_path / "rid")
    spark.range(3).write.parquet(out)
    with pytest.raises(EmptyStageError):
        pipelines.ridership_job(spark, str(tmp_path / "subway"), dims["area_mapping"], dims["exam_periods"], out)
    assert spark.read.parquet(out).count() == 3


def test_cli_reports_missing_paths():
    from periodlens import cli

    with pytest.raises(SystemExit, match="missing --input"):
        cli.main(["population", "--mapping", "m.csv", "--periods", "p.csv", "--output", "out"])
    with pytest.raises(SystemExit, match="missing --population, --ridership"):
        cli.main(["reports"])
