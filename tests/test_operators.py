"""Unit tests per operator on tiny literal frames (edge fixtures of FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from periodlens.functions.columns import (
    clean_header_name,
    date_parts,
    guarded_ratio,
    lenient_date,
    lift,
    parse_count,
    safe_row_sum,
    time_band,
    try_number,
)
from periodlens.operators.facts import population_fact, ridership_fact
from periodlens.operators.ingest import subway_columns, subway_observations
from periodlens.operators.joins import join_dimension
from periodlens.operators.metrics import ranked, with_zscores
from periodlens.operators.periods import expand_calendar, label_periods, overlapping_periods
from periodlens.operators.quality import EmptyStageError, Gates, is_nonempty
from periodlens.operators.reshape import columns_to_rows, rows_to_columns
from periodlens.plans.reports import REPORTS
from periodlens.sources.csv import CsvLayout, normalize_to_utf8, read_csv_layouts, resolve_columns
from periodlens.sources.dimensions import calendar_from_rows, typed_periods

D = dt.date


def cal(spark, rows):
    return calendar_from_rows(spark, rows)


def test_time_band_edges(spark):
    hours = [0, 2, 3, 17, 18, 20, 21, 23, 24, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r["b"] for r in df.select(time_band("h").alias("b")).collect()]
    assert got == ["late_night", "late_night", "other", "other", "evening", "evening", "night", "night", "other", "other"]


def test_date_parts(spark):
    df = spark.createDataFrame([(D(2025, 11, 1),), (D(2025, 4, 14),)], "d date")
    parts = date_parts("d")
    got = [tuple(r) for r in df.select(*[c.alias(k) for k, c in parts.items()]).collect()]
    assert got == [(2025, 11, "Sat", 7, True), (2025, 4, "Mon", 2, False)]


def test_parsers(spark):
    df = spark.createDataFrame([("20250431", "1,000", "*"), ("2025-04-14", "12", "3.5"), ("x", "", None)], "d string, n string, v string")
    got = df.select(lenient_date("d").alias("d"), parse_count("n").alias("n"), try_number("v").alias("v")).collect()
    assert [tuple(r) for r in got] == [(None, 1000, None), (D(2025, 4, 14), 12, 3.5), (None, None, None)]


def test_try_integer_truncates_like_legacy_cast(spark):
    from periodlens.functions.columns import try_integer

    df = spark.createDataFrame([("18.0",), (" 18 ",), ("18.7",), ("x",), ("-2.9",), (None,)], "s string")
    assert [r["i"] for r in df.select(try_integer("s").alias("i")).collect()] == [18, 18, 18, None, -2, None]


def test_safe_row_sum_guarded_ratio_lift(spark):
    df = spark.createDataFrame([(1.0, None, 0.0), (None, None, 5.0), (2.0, 3.0, None)], "a double, b double, base double")
    got = df.select(
        safe_row_sum(["a", "b"]).alias("s"), guarded_ratio("a", "base").alias("r"), lift("base", "a").alias("l")
    ).collect()
    assert [tuple(r) for r in got] == [(1.0, None, None), (0.0, None, None), (5.0, None, None)]
    one = spark.createDataFrame([(2.0, 3.0)], "b double, n double").select(lift("b", "n").alias("l")).first()["l"]
    assert one == 0.5


@pytest.mark.parametrize(
    "raw,name",
    [('\ufeff"기준일ID" ', "기준일ID"), ("?수송일자", "수송일자"), (' "a b" ', "a b"), ("??x?", "x?"), ('x"\ufeffy', "xy"), ("", ""), ("?", ""), ("  ", "")],
)
def test_clean_header_name(raw, name):
    assert clean_header_name(raw) == name


def test_ranked_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [("1", "m", "b", 0.5), ("1", "m", "a", 0.5), ("1", "m", "c", None), ("1", "m", "d", 0.7)],
        "semester string, exam_type string, area_id string, lift double",
    )
    got = {r["area_id"]: r["rank_no"] for r in ranked(df, ["semester", "exam_type"], "lift").collect()}
    assert got == {"d": 1, "a": 2, "b": 3, "c": 4}


@pytest.mark.parametrize("method", ["window", "aggregate"])
def test_zscores(spark, method):
    df = spark.createDataFrame([("p", 1.0), ("p", 1.0), ("q", 1.0), ("q", 3.0)], "k string, x double")
    got = sorted((r["k"], r["x"], r["z"]) for r in with_zscores(df, {"z": "x"}, ["k"], method).collect())
    assert got == [("p", 1.0, None), ("p", 1.0, None), ("q", 1.0, -1.0), ("q", 3.0, 1.0)]


PERIODS = [
    (2025, 1, "midterm", "before", D(2025, 4, 14), D(2025, 4, 20)),
    (2025, 1, "midterm", "after", D(2025, 5, 1), D(2025, 5, 7)),
    (2025, 1, "bad", "after", D(2025, 5, 9), D(2025, 5, 8)),  # inverted: matches nothing
]


@pytest.mark.parametrize("strategy", ["expanded", "range"])
def test_label_periods_forms_agree(spark, strategy):
    days = spark.createDataFrame([(D(2025, 4, 14),), (D(2025, 5, 8),), (D(2025, 5, 9),), (D(2025, 3, 1),)], "date date")
    got = sorted(tuple(r) for r in label_periods(days, cal(spark, PERIODS), strategy=strategy).select(
        "date", "phase", "exam_type", "semester").collect())
    assert got == [
        (D(2025, 3, 1), "normal", "normal", None),
        (D(2025, 4, 14), "before", "midterm", 1),
        (D(2025, 5, 8), "normal", "normal", None),
        (D(2025, 5, 9), "normal", "normal", None),
    ]


def test_overlap_fans_out_and_validator_fires(spark):
    rows = PERIODS[:2] + [(2025, 1, "festival", "during", D(2025, 4, 18), D(2025, 4, 22))]
    days = spark.createDataFrame([(D(2025, 4, 19),)], "date date")
    labelled = label_periods(days, cal(spark, rows))
    assert labelled.count() == 2
    flags = {r["exam_type"]: (r["period_days"], r["overlap_days"], r["is_overlapping"]) for r in overlapping_periods(cal(spark, rows)).collect()}
    assert flags["festival"] == (5, 3, True)
    assert flags["midterm"] in {(7, 3, True), (7, 0, False)}
    assert overlapping_periods(cal(spark, PERIODS)).filter("is_overlapping").count() == 0


def test_unparsable_semester_excluded(spark):
    raw = spark.createDataFrame(
        [("2025", "x", "midterm", "before", "2025-04-14", "2025-04-20", ""), ("2025", "1", "midterm", "after", "2025-05-01", "2025-05-07", "")],
        "year string, semester string, exam_type string, phase string, start_date string, end_date string, notes string",
    )
    periods = typed_periods(raw)
    obs = spark.createDataFrame(
        [(D(2025, 4, 14), 18, "u", 10.0, 1.0), (D(2025, 5, 1), 18, "u", 20.0, 2.0)],
        "date date, hour int, unit_code string, total_population double, young_20s_population double",
    )
    units = spark.createDataFrame([("u", "a", "A", "university")], "unit_code string, area_id string, area_name string, area_type string")
    fact = population_fact(obs, units, periods)
    r1 = REPORTS["population_phase_change"].build(fact, None).collect()
    assert len(r1) == 1 and r1[0]["before_population"] is None and r1[0]["after_population"] == 20.0


def _obs(spark, rows):
    return spark.createDataFrame(rows, "date date, hour int, unit_code string, total_population double, young_20s_population double")


def _units(spark):
    return spark.createDataFrame(
        [("u1", "a", "A", "university"), ("u2", "b", "B", "nightlife"), ("u3", "b", "B", "nightlife"), ("u3", "a", "A", "university")],
        "unit_code string, area_id string, area_name string, area_type string",
    )


def test_fact_rollup_null_totals_and_shared_units(spark):
    obs = _obs(spark, [
        (D(2025, 4, 14), 18, "u2", None, 1.0),
        (D(2025, 4, 14), 18, "u2", None, None),
        (D(2025, 4, 14), 19, "u3", 10.0, 4.0),  # unit in two areas counts in both
        (D(2025, 4, 14), 12, "u1", 99.0, 9.0),  # band other: dropped
        (None, 18, "u1", 99.0, 9.0),  # no date: dropped
    ])
    fact = population_fact(obs, _units(spark), cal(spark, PERIODS))
    got = sorted((r["area_id"], r["hour"], r["total_population"], r["young_20s_population"], r["young_20s_ratio"]) for r in fact.collect())
    assert got == [("a", 19, 10.0, 4.0, 0.4), ("b", 18, None, 1.0, None), ("b", 19, 10.0, 4.0, 0.4)]


def test_by_year_vs_pooled(spark):
    rows = [
        (2025, 1, "midterm", "before", D(2025, 4, 14), D(2025, 4, 14)),
        (2025, 1, "midterm", "after", D(2025, 5, 1), D(2025, 5, 1)),
        (2026, 1, "midterm", "before", D(2026, 4, 13), D(2026, 4, 13)),
        (2026, 1, "midterm", "after", D(2026, 4, 28), D(2026, 4, 28)),
    ]
    obs = _obs(spark, [
        (D(2025, 4, 14), 18, "u1", 10.0, 1.0), (D(2025, 5, 1), 18, "u1", 20.0, 2.0),
        (D(2026, 4, 13), 18, "u1", 30.0, 3.0), (D(2026, 4, 28), 18, "u1", 90.0, 9.0),
    ])
    pooled = population_fact(obs, _units(spark), cal(spark, rows))
    split = population_fact(obs, _units(spark), cal(spark, rows), by_year=True)
    r1 = REPORTS["population_phase_change"]
    p = r1.build(pooled, None).first()
    assert (p["before_population"], p["after_population"]) == (20.0, 55.0)
    s = sorted((r["exam_year"], r["before_population"], r["after_population"]) for r in r1.build(split, None, by_year=True).collect())
    assert s == [(2025, 10.0, 20.0), (2026, 30.0, 90.0)]


def test_late_night_previous_day(spark):
    rows = [(2025, 1, "midterm", "before", D(2025, 4, 14), D(2025, 4, 20))]
    obs = _obs(spark, [(D(2025, 4, 14), 0, "u1", 5.0, 1.0)])
    same = population_fact(obs, _units(spark), cal(spark, rows)).first()
    prev = population_fact(obs, _units(spark), cal(spark, rows), late_night="previous_day").first()
    assert (same["date"], same["phase"]) == (D(2025, 4, 14), "before")
    assert (prev["date"], prev["phase"]) == (D(2025, 4, 13), "normal")


def test_only_literal_dimensions_carry_a_hint(spark):
    fact = spark.range(10).withColumnRenamed("id", "k")
    dim = spark.range(5).withColumnRenamed("id", "k")
    hint = lambda df: "strategy=broadcast" in df._jdf.queryExecution().logical().toString()
    assert hint(join_dimension(fact, dim, "k", literal=True)) and not hint(join_dimension(fact, dim, "k"))
    assert join_dimension(fact, dim, "k").count() == 5


def test_reshape_roundtrip(spark):
    df = spark.createDataFrame([("x", 18, 2), ("x", 0, 1), ("y", 18, 4)], "id string, hour int, n long")
    wide = rows_to_columns(df, ["id"], "hour", "n", [18, 0])
    assert sorted(tuple(r) for r in wide.collect()) == [("x", 2, 1), ("y", 4, None)]
    long = columns_to_rows(wide, ["id"], [(18, "h18"), (0, "h00")], "hour", "n").filter("n IS NOT NULL")
    assert sorted(tuple(r) for r in long.collect()) == [("x", 0, 1), ("x", 18, 2), ("y", 18, 4)]


def test_missing_columns_are_reported_together_before_any_job():
    cols = ["수송일자", "역명", "승하차구분", "승객유형", "18시", "19시", "20시", "21시", "22시", "23시"]
    with pytest.raises(ValueError, match="line name.*; 0 "):
        subway_columns(cols)
    names, hours = subway_columns([*cols, "호선", "24시간대이후", "02시"])
    assert names["line name"] == "호선" and hours[-2:] == [(0, "24시간대이후"), (2, "02시")]
    assert resolve_columns(["a", "c"], {"x": ["b", "c"], "y": ["d"]}, optional=["y"]) == {"x": "c"}


def test_layout_safe_reader(spark, tmp_path):
    a = tmp_path / "feed" / "a.csv"
    b = tmp_path / "feed" / "b.csv"
    a.parent.mkdir()
    hours_a = ["18시", "19시", "20시", "21시", "22시", "23시", "00시"]
    hours_b = ["18-19시간대", "19-20시간대", "20-21시간대", "21-22시간대", "22-23시간대", "23-24시간대", "24시간대이후"]
    a.write_bytes(("수송일자,호선명,역명,승하차구분,승객유형," + ",".join(hours_a) + "\n2025-04-14,2,신촌,하차,일반,1,,,,,,7\n").encode("utf-8"))
    # layout B: other hour names, reversed columns, CP949
    cols_b = ["수송일자", "호선", "역명", "승하차구분", "승객유형", *hours_b][::-1]
    vals_b = ["20250415", "2", "신촌", "하차", "일반", "2", "", "", "", "", "", "\"1,005\""][::-1]
    b.write_bytes((",".join(cols_b) + "\n" + ",".join(vals_b) + "\n").encode("cp949"))
    obs = read_csv_layouts(spark, str(tmp_path / "feed"), per_layout=subway_observations)
    got = sorted((r["date"], r["hour"], r["alighting_count"]) for r in obs.collect())
    assert got == [(D(2025, 4, 14), 0, 7), (D(2025, 4, 14), 18, 1), (D(2025, 4, 15), 0, 1005), (D(2025, 4, 15), 18, 2)]


def test_gates(spark):
    gates = Gates("t")
    df = gates.watch(spark.range(3), "all")
    empty = gates.watch(df.filter("id > 5"), "none")
    empty.write.format("noop").mode("overwrite").save()
    assert gates.counts() == {"all": 3, "none": 0}
    with pytest.raises(EmptyStageError):
        gates.check()
    assert is_nonempty(spark.range(1)) and not is_nonempty(spark.range(0))


def test_expand_calendar_skips_inverted(spark):
    assert expand_calendar(cal(spark, PERIODS)).count() == 14


def test_ridership_fact_types(spark):
    obs = spark.createDataFrame([(D(2025, 4, 14), 18, "u1", 3)], "date date, hour int, unit_code string, alighting_count long")
    fact = ridership_fact(obs, _units(spark), cal(spark, PERIODS))
    assert dict(fact.dtypes)["alighting_count"] == "bigint" and fact.first()["alighting_count"] == 3


def test_rollup_without_broadcast_sums_before_the_unit_join(spark):
    """With broadcasting off the plan has a sort-merge join on the unit, and it carries sums:
    a unit that holds a third of the rows is one row per (date, hour) there."""
    rows = [(D(2025, 4, 14 + (i % 7)), 18 + (i % 3), "u1" if i % 3 == 0 else f"u{2 + i % 2}", float(i), 1.0) for i in range(300)]
    obs = _obs(spark, rows)
    fast = sorted(map(tuple, population_fact(obs, _units(spark), cal(spark, PERIODS)).collect()), key=str)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        slow = population_fact(obs, _units(spark), cal(spark, PERIODS))
        plan = slow._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, slow.collect()), key=str) == fast
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    below = plan[plan.index("SortMergeJoin [unit_code"):]
    assert "partial_sum(total_population" in below and "keys=[date" in below
    assert len(fast) == 35  # 7 days x (hour 18: area a; hours 19, 20: areas a and b)


def test_dynamic_partition_overwrite(spark, tmp_path):
    from periodlens.sinks import write_parquet

    path = str(tmp_path / "fact")
    jan = spark.createDataFrame([(2025, 1, 1.0), (2025, 2, 2.0)], "year int, month int, v double")
    write_parquet(jan, path, ("year", "month"))
    feb = spark.createDataFrame([(2025, 2, 5.0)], "year int, month int, v double")
    write_parquet(feb, path, ("year", "month"), replace_partitions_only=True)
    got = sorted((r["month"], r["v"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1.0), (2, 5.0)]


def test_exact_avg(spark):
    from periodlens.operators.metrics import conditional_avg, exact_avg

    df = spark.createDataFrame([("a", 0.1), ("a", 0.2), ("a", 0.3), ("b", None)], "k string, x double")
    got = {r["k"]: (r["plain"], r["exact"], r["none"]) for r in df.groupBy("k").agg(
        exact_avg("x").alias("plain"), exact_avg("x", 2).alias("exact"),
        conditional_avg("x", F.col("x") > 1, 2).alias("none"),
    ).collect()}
    assert got["a"][1] == 0.2 and abs(got["a"][0] - 0.2) < 1e-12 and got["a"][2] is None
    assert got["b"] == (None, None, None)


def test_source_bytes_and_encoding_detection(spark, tmp_path):
    import os

    from periodlens.sources.csv import detect_encodings, require_min_bytes, source_bytes

    (tmp_path / "a.csv").write_bytes("역명,n\n신촌,1\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("역명,n\n이대,2\n".encode("cp949"))
    total = sum(os.path.getsize(tmp_path / f) for f in ("a.csv", "b.csv"))
    row = source_bytes(spark, str(tmp_path)).first()
    assert (row["files"], row["bytes"]) == (2, total)
    assert require_min_bytes(spark, str(tmp_path), total) == total
    with pytest.raises(ValueError):
        require_min_bytes(spark, str(tmp_path), total + 1)
    found = {os.path.basename(p): c for p, c in detect_encodings(spark, str(tmp_path)).items()}
    assert found == {"a.csv": "UTF-8", "b.csv": "CP949"}


def test_table_helpers(spark, tmp_path):
    from periodlens.sinks import POPULATION_FACT_SCHEMA, drop_table, register_fact_table, save_table, use_database

    db = f"t_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_path / 'wh'}'")
    spark.createDataFrame([], POPULATION_FACT_SCHEMA).write.parquet(str(tmp_path / "fact"))
    register_fact_table(spark, db, "area_population", str(tmp_path / "fact"))
    assert spark.table(f"{db}.area_population").schema == POPULATION_FACT_SCHEMA
    save_table(spark.range(2), f"{db}.result_x")
    assert spark.table(f"{db}.result_x").count() == 2
    drop_table(spark, f"{db}.result_x")
    assert not spark.catalog.tableExists(f"{db}.result_x")
    use_database(spark, db)
    assert spark.catalog.currentDatabase() == db
    use_database(spark, "default")


def test_reader_handles_spaces_brackets_and_percent_in_file_names(spark, tmp_path):
    (tmp_path / "서울 지하철 2025.csv").write_bytes("역명,n\n신촌,1\n".encode("cp949"))
    (tmp_path / "plain file [1].csv").write_bytes("역명,n\n이대,2\n".encode("utf-8"))
    (tmp_path / "pct%20name.csv").write_bytes("역명,n\n강남,3\n".encode("utf-8"))
    got = sorted(tuple(r) for r in read_csv_layouts(spark, str(tmp_path)).collect())
    assert got == [("강남", "3"), ("신촌", "1"), ("이대", "2")]


def test_undecodable_files_are_named(spark, tmp_path):
    (tmp_path / "good.csv").write_bytes("역명,n\n신촌,1\n".encode("cp949"))
    (tmp_path / "broken.csv").write_bytes("역명,n\n".encode("cp949") + b"\x80\xff\xfe,2\n")
    for read in (read_csv_layouts, lambda s, p: normalize_to_utf8(s, p, str(tmp_path / "out"))):
        with pytest.raises(ValueError, match="broken.csv"):
            read(spark, str(tmp_path / "*.csv"))
    stated = read_csv_layouts(spark, [CsvLayout(str(tmp_path / "*.csv"), "CP949")])
    with pytest.raises(Exception, match="not valid CP949.*broken.csv"):
        stated.collect()


def test_stated_layouts_check_the_header_of_every_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_layouts(spark, [CsvLayout(str(tmp_path))]).collect()


def test_normalized_lines_keep_their_cells(spark, tmp_path):
    import glob

    lines = ["\ufeff\"역명\",코드,n", " 11440660,  신촌 ,1", "a,,", "ragged,1,2,넷", '"x, y",\'q\',"a ""b"""', "한,둘,셋"]
    for name, charset in (("old.csv", "cp949"), ("new.csv", "utf-8")):
        (tmp_path / name).write_bytes("\n".join(lines if charset == "utf-8" else [lines[0][1:], *lines[1:]]).encode(charset))
    folders = normalize_to_utf8(spark, str(tmp_path / "*.csv"), str(tmp_path / "out"))
    got = []
    for folder in folders:
        for part in sorted(glob.glob(f"{folder}/part-*")):
            text = open(part, encoding="utf-8").read().split("\n")
            assert text[0].lstrip("\ufeff") == lines[0][1:]
            got += text[1:-1]
    assert sorted(got) == sorted(lines[1:] * 2)
    # and the blanks are there when the rewritten files are read
    rows = read_csv_layouts(spark, [CsvLayout(f) for f in folders])
    assert rows.columns == ["역명", "코드", "n"] and rows.filter("`코드` = '  신촌 '").count() == 2


def test_raw_bytes_of_a_stated_layout_are_read_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n" + "1,2\n" * 50)
    df = read_csv_layouts(spark, [CsvLayout(str(tmp_path))]).groupBy("x").count()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and df.first()["count"] == 50


def test_ranked_range_keeps_payload_and_null_groups(spark):
    rows = [(i % 4 or None, (i * 37) % 11 if i % 5 else None, i, f"payload {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "k int, x int, id int, note string")
    args = (["k"], "x", "r", ("id",))
    window, ranges = ranked(df, *args), ranked(df.repartition(7), *args, method="range", num_ranges=9)
    assert sorted(map(str, window.collect())) == sorted(map(str, ranges.collect())) and ranges.columns == window.columns


def test_zscores_of_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 1.0)], "k string, x double")
    rows = lambda m: sorted(map(str, with_zscores(df, {"z": "x"}, ["k"], m).collect()))
    assert rows("window") == rows("aggregate")


def test_publish_keeps_the_old_output_when_a_check_fails(spark, tmp_path):
    from periodlens.plans.pipelines import _publish

    out = str(tmp_path / "fact")
    _publish(spark, spark.range(3), out)
    _publish(spark, spark.range(5), out)
    assert spark.read.parquet(out).count() == 5

    def fail():
        raise EmptyStageError("nothing")

    with pytest.raises(EmptyStageError):
        _publish(spark, spark.range(9), out, check=fail)
    assert spark.read.parquet(out).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["fact"]  # nothing staged is left


def test_gates_tell_unknown_units_from_units_without_an_area(spark):
    obs = spark.createDataFrame([(D(2025, 4, 14), 18, u, 1) for u in ("u1", "u1", "gone", "bare")], "date date, hour int, unit_code string, alighting_count long")
    units = spark.createDataFrame([("u1", "a", "A", "x"), ("bare", None, None, None)], "unit_code string, area_id string, area_name string, area_type string")
    gates = Gates("t")
    fact = ridership_fact(obs, units, cal(spark, PERIODS), gates=gates)
    assert fact.first()["alighting_count"] == 2
    assert gates.counts() == {"night hours": 4, "unit lookup": 3, "area lookup": 2}
