"""Layout manifest: new files only, one pass, no list of files on the driver."""

import os
import time

import pytest
from pyspark.sql import functions as F

from periodlens.session import staging_path
from periodlens.sources import manifest as m

WANTED = {"day": ["날짜", "date"], "n": ["수", "count"]}


def put(folder, name, text, charset="utf-8", when=None):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_bytes(text.encode(charset))
    if when is not None:
        os.utime(path, (when, when))
    return path


@pytest.fixture
def feed(tmp_path):
    old = time.time() - 1000
    put(tmp_path / "in", "a.csv", '﻿날짜,수,비고\n1,10,"가,나"\n2,20,�\n', when=old)
    put(tmp_path / "in", "b [1].csv", "count,date\n30,3\n40,4\n", "cp949", old + 1)
    put(tmp_path / "in", "c.csv", "날짜,수\n5,50\n", "cp949", old + 2)
    put(tmp_path / "in", "empty.csv", "", when=old + 3)
    return tmp_path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_one_frame_from_all_layouts(spark, feed):
    base = str(feed / "in")
    assert m.update_manifest(spark, base, str(feed / "m")) == 3
    charsets = {r["path"].rsplit("/", 1)[1]: r["charset"] for r in m.read_manifest(spark, str(feed / "m")).collect()}
    assert charsets == {"a.csv": "UTF-8", "b%20%5B1%5D.csv": "UTF-8", "c.csv": "CP949"}
    df = m.read_csv_manifest(spark, base, str(feed / "m"), WANTED)
    assert rows(df) == [("1", "10"), ("2", "20"), ("3", "30"), ("4", "40"), ("5", "50")]
    every = m.read_csv_manifest(spark, base, str(feed / "m"))
    assert set(every.columns) == {"날짜", "수", "비고", "count", "date"}
    assert {r["비고"] for r in every.collect()} == {None, "가,나", "�"}


def test_only_new_files_are_read(spark, feed):
    base, manifest = str(feed / "in"), str(feed / "m")
    m.update_manifest(spark, base, manifest)
    assert m.update_manifest(spark, base, manifest) == 0
    known = feed / "in" / "a.csv"
    stat = known.stat()
    known.write_bytes(b"\xff" * stat.st_size)  # bytes that no charset knows, under the same size and time
    os.utime(known, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    put(feed / "in", "d.csv", "date,count\n6,60\n")
    assert m.update_manifest(spark, base, manifest) == 1
    got = m.read_manifest(spark, manifest)
    assert got.count() == 4 and got.where("charset is null").isEmpty()
    plan = m.profiled(spark, base, got.agg(F.max("modified")).first()[0])
    scanned = {os.path.basename(f) for f in plan._jdf.queryExecution().executedPlan().toString().split() if f.endswith(".csv")}
    assert "a.csv" not in scanned
    assert plan.select("path").collect()[0]["path"].endswith("d.csv") and plan.count() == 1


def test_changed_file_gets_a_new_version(spark, feed):
    base, manifest = str(feed / "in"), str(feed / "m")
    m.update_manifest(spark, base, manifest)
    put(feed / "in", "c.csv", "date,count\n7,70\n8,80\n")
    with pytest.raises(ValueError, match="not in the manifest"):
        m.read_csv_manifest(spark, base, manifest, WANTED)
    assert m.update_manifest(spark, base, manifest) == 1
    assert ("7", "70") in rows(m.read_csv_manifest(spark, base, manifest, WANTED))
    assert ("5", "50") not in rows(m.read_csv_manifest(spark, base, manifest, WANTED))


def test_errors_name_a_file(spark, feed):
    base, manifest = str(feed / "in"), str(feed / "m")
    (feed / "in" / "bad.csv").write_bytes(b"date,count\n\xff\xfe\xff,1\n")
    m.update_manifest(spark, base, manifest)
    with pytest.raises(ValueError, match="bad.csv"):
        m.read_csv_manifest(spark, base, manifest, WANTED)
    (feed / "in" / "bad.csv").unlink()
    put(feed / "in", "other.csv", "x,y\n1,2\n")
    m.update_manifest(spark, base, manifest)
    with pytest.raises(ValueError, match="day"):
        m.read_csv_manifest(spark, base, manifest, WANTED)


def test_bytes_are_scanned_once_without_python(spark, feed):
    base, manifest = str(feed / "in"), str(feed / "m")
    m.update_manifest(spark, base, manifest)
    plan = m.read_csv_manifest(spark, base, manifest, WANTED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan csv") == 1 and "Scan text" not in plan
    assert "Python" not in plan and "MapIn" not in plan


def test_large_feeds_join_without_broadcast_of_files(spark, feed, monkeypatch):
    monkeypatch.setattr(m, "MOST_SENT", 1)
    base, manifest = str(feed / "in"), staging_path(spark, "m")
    m.update_manifest(spark, base, manifest)
    assert len(rows(m.read_csv_manifest(spark, base, manifest, WANTED))) == 5


def test_strict_reading_takes_a_replacement_character_that_is_in_the_file(spark, feed):
    from periodlens.sources.csv import read_csv_strings

    (feed / "one").mkdir()
    (feed / "one" / "x.csv").write_text("a,b\n�,1\n", encoding="utf-8")
    assert rows(read_csv_strings(spark, str(feed / "one"), strict=True)) == [("�", "1")]
    (feed / "one" / "y.csv").write_bytes(b"a,b\n\xff\xfe,1\n")
    with pytest.raises(Exception, match="y.csv"):
        read_csv_strings(spark, str(feed / "one"), strict=True).collect()


def test_normalizing_runs_without_python(spark, feed, monkeypatch):
    from periodlens.sources import csv as source
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    def none(*_):
        raise AssertionError("a Python worker")

    monkeypatch.setattr(Classic, "mapInPandas", none)
    monkeypatch.setattr(Classic, "mapInArrow", none)
    (feed / "in" / "empty.csv").unlink()
    folders = source.normalize_to_utf8(spark, str(feed / "in"), str(feed / "out"))
    assert len(folders) == 3
    got = sorted(r["value"] for r in spark.read.text([f + "/*.csv" for f in folders]).collect())
    assert got == sorted(["날짜,수,비고", '1,10,"가,나"', "2,20,�", "count,date", "30,3", "40,4", "날짜,수", "5,50"])
