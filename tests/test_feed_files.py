"""File feeds by manifest, header reads, and sorted writes."""

import glob
import gzip
import json
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from quotelake import sources as src
from quotelake.plans import ingest
from quotelake.plans.jobs import FileFeedJob
from quotelake.sources import files
from tests.conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def earnings(*symbols, **fields):
    return json.dumps({"earningsDates": [{"Symbol": s, **fields} for s in symbols]})


def test_dates_of_any_source(spark, tmp_path):
    reported, upcoming, target = (str(tmp_path / n) for n in ("rep", "upc", "stage"))
    write(tmp_path / "upc" / "u_20250102.json", earnings("A", EstimatedEPS="1"))
    assert ingest.stage_earnings(spark, reported, upcoming, target) == ["20250102"]
    write(tmp_path / "rep" / "r_20250103.json", earnings("B", ActualEPS="2"))
    assert ingest.stage_earnings(spark, reported, upcoming, target) == ["20250103"]
    write(tmp_path / "rep" / "r_20250102.json", earnings("A", "C", ActualEPS="3"))
    assert ingest.stage_earnings(spark, reported, upcoming, target) == ["20250102"]
    got = rows(src.read_partitioned(spark, target), "Symbol")
    assert [(r["Symbol"], r["ActualEPS"], r["Upcoming_EstimatedEPS"], r["file_version_date"]) for r in got] == [
        ("A", "3", "1", "20250102"),
        ("B", "2", None, "20250103"),
        ("C", "3", None, "20250102"),
    ]
    assert ingest.stage_earnings(spark, reported, upcoming, target) == []


def test_single_class_dates(spark, tmp_path):
    paths = {name: str(tmp_path / name) for name in ("largecap", "midcap", "smallcap", "etf")}
    write(tmp_path / "midcap" / "m_20250102.json", '[{"date":"2025-01-02"},{"symbol":"M"}]')
    write(tmp_path / "largecap" / "l_20250103.json", '[{"date":"2025-01-03"},{"symbol":"L"}]')
    target = str(tmp_path / "stage")
    assert ingest.stage_technical_rank(spark, paths, target) == ["20250102", "20250103"]
    got = rows(src.read_partitioned(spark, target), "symbol")
    assert [(r["symbol"], r["marketcaptype"], r["date"]) for r in got] == [("L", "large", "2025-01-03"), ("M", "mid", "2025-01-02")]


def test_late_corrected_and_archived_files(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "raw")
    build = lambda: ingest.build_raw(spark, str(landing), target, follow_changes=True)
    symbols = lambda: [(r["sym"], r["file_version_date"]) for r in rows(src.read_partitioned(spark, target), "sym")]
    one = landing / "a_2025-01-02.csv"
    write(one, "sym\nA\n")
    write(landing / "a_2025-01-03.csv", "sym\nB\n")
    write(landing / "no date.csv", "sym\nX\n")
    assert build() == ["20250102", "20250103"] and build() == []
    late = landing / "b_2025-01-02.csv"
    write(late, "sym\nC\n")
    assert build() == ["20250102"] and symbols() == [("A", "20250102"), ("B", "20250103"), ("C", "20250102")]
    write(one, "sym\nD\n")
    os.utime(one, (10**9, 10**9))
    assert build() == ["20250102"] and symbols() == [("B", "20250103"), ("C", "20250102"), ("D", "20250102")]
    late.unlink()
    assert build() == ["20250102"] and symbols() == [("B", "20250103"), ("D", "20250102")]
    # All files of a day archived: the day stays as it is.
    one.unlink()
    assert build() == [] and len(symbols()) == 2


def test_dates_from_before_the_manifest(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "raw")
    write(landing / "a_2025-01-02.csv", "sym\nA\n")
    write(landing / "a_2025-01-03.csv", "sym\nB\n")
    src.record_processed(spark, f"{target}/_processed", ["20250102"])
    assert ingest.build_raw(spark, str(landing), target) == ["20250103"]
    assert ingest.build_raw(spark, str(landing), target) == []
    assert ingest.build_raw(spark, str(landing), target, rerun=["20250102"]) == ["20250102"]


def test_required_source_and_failed_date(spark, tmp_path):
    for name, date in (("l", "20250102"), ("l", "20250103"), ("r", "20250103"), ("r", "20250104")):
        write(tmp_path / name / f"f_{date}.csv", f"v\n{'bad' if date == '20250103' and name == 'r' else 1}\n")
    read = lambda spark, files: src.read_csv_by_header(spark, files)
    both = lambda left, right: left.join(right, ["file_version_date"]).select(
        F.col("file_version_date"), right["v"].cast("int").alias("v")
    )
    sources = {"left": (str(tmp_path / "l"), read), "right": (str(tmp_path / "r"), read)}
    job = FileFeedJob(sources, both, str(tmp_path / "out"), required=["left", "right"])
    assert job.run(spark) == [] and job.failed == ["20250103"]
    write(tmp_path / "r" / "f_20250103.csv", "v\n25\n")
    assert job.run(spark) == ["20250103"] and job.run(spark) == []


def test_headers_read_a_bounded_head(spark, tmp_path, monkeypatch):
    wide = ",".join(f"column{i}" for i in range(9_000))
    write(tmp_path / "in" / "a_2025-01-02.csv", "﻿x,\"y, z\"\r\n" + "1,2\r\n" * 60_000)
    write(tmp_path / "in" / "b_2025-01-02.csv", wide + "\n" + ",".join("1" * 9_000) + "\n")
    write(tmp_path / "in" / "c_2025-01-02.csv", "")
    write(tmp_path / "in" / "d_2025-01-02.csv", "only")
    (tmp_path / "in" / "e_2025-01-02.csv.gz").write_bytes(gzip.compress(b"g,h\n" + os.urandom(200_000).hex().encode()))
    asked = []
    head = files.read_head
    monkeypatch.setattr(files, "read_head", lambda spark, file, size: asked.append((file, size)) or head(spark, file, size))
    found = {os.path.basename(f): h for f, h in src.csv_headers(spark, str(tmp_path / "in")).items()}
    assert found.pop("b_2025-01-02.csv") == tuple(wide.split(","))
    assert found == {
        "a_2025-01-02.csv": ("x", "y, z"), "d_2025-01-02.csv": ("only",), "e_2025-01-02.csv.gz": ("g", "h"),
    }
    assert all(size <= files.HEAD_BYTES for file, size in asked if "/b_" not in file)
    assert len([f for f, _ in asked if "/a_" in f or "/e_" in f]) == 2
    frame = src.read_csv_by_header(spark, str(tmp_path / "in" / "a_2025-01-02.csv"))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and frame.count() == 60_000


def test_stage_csv_of_quoted_line_breaks(spark, tmp_path):
    write(tmp_path / "in" / "a_2025-01-02.csv", 'Full Name,Note\nX,"two\nlines"\nY,\n')
    ingest.stage_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"Full Name": "name", "Note": "note"}, multiline=True)
    got = rows(src.read_partitioned(spark, str(tmp_path / "out")), "name")
    assert [(r["name"], r["note"]) for r in got] == [("X", "two\nlines"), ("Y", "")]


def test_sorted_writes_do_not_overlap(spark, tmp_path):
    df = spark.range(40_000).select(
        F.concat(F.lit("S"), F.lpad((F.col("id") * 7919 % 400).cast("string"), 3, "0")).alias("symbol"),
        (F.col("id") % 97).alias("strike"), F.lit("20250102").alias("file_version_date"),
    )
    src.write_partitions(df, str(tmp_path / "t"), sort_by=["symbol", "strike"], files=12)
    spans = []
    for file in glob.glob(f"{tmp_path}/t/file_version_date=20250102/*.parquet"):
        own = pq.read_table(file).to_pylist()
        keys = [(r["symbol"], r["strike"]) for r in own]
        assert keys == sorted(keys)
        groups = pq.ParquetFile(file).metadata
        for g in range(groups.num_row_groups):
            stats = groups.row_group(g).column(0).statistics
            spans.append((stats.min, stats.max))
    assert len(spans) >= 10
    for symbol in ("S000", "S123", "S399"):
        hit = sum(low <= symbol <= high for low, high in spans)
        assert 1 <= hit <= len(spans) / 5
    assert src.read_partitioned(spark, str(tmp_path / "t")).count() == 40_000


@pytest.mark.parametrize("parts", [None, 7])
def test_ranges_of_a_hot_key(spark, parts):
    from quotelake import operators as op

    data = [("hot", i, i * i % 91) for i in range(600)] + [("none", None, 5), (None, 3, 4), (None, 1, 2), ("one", 8, None)]
    data += [("two", 1, None), ("two", 2, 6), ("two", 2, 9), ("two", None, 1)]
    df = spark.createDataFrame(data, "k string, day int, v int").repartition(3)
    if parts:
        blocks = op.range_blocks(df, ["k", "day"], parts)
        assert blocks.where("k = 'hot'").select("__block").distinct().count() >= 4
    got = rows(op.ranged_neighbours(df, ["k"], ["day"], "v", parts=parts))
    expected = []
    for k in {r[0] for r in data}:
        own = sorted((r for r in data if r[0] == k), key=lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or 0))
        days = [r[1] for r in own if r[1] is not None]
        newest = max((r[2] for r in own if days and r[1] == max(days) and r[2] is not None), default=None)
        values = [r[2] for r in own]
        for row, before, after in zip(own, [None, *values], [*values[1:], None], strict=False):
            expected.append((*row, before, after, newest))
    found = [(r["k"], r["day"], r["v"], r["prev"], r["next"], r["last"]) for r in got]
    assert sorted(map(str, found)) == sorted(map(str, expected))


@pytest.mark.parametrize("null_metric", ["last", "ignore"])
def test_percentiles_of_dense_values(spark, null_metric):
    from quotelake import operators as op

    # Thousands of values closer to each other than any fixed grid of a double's octave is.
    df = spark.range(3_000).select(
        "id", (F.col("id") % 5 > 0).cast("string").alias("g"),
        F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 13 == 0, float("nan"))
        .otherwise(1 + F.pmod(F.col("id") * 7919, 3001) * F.lit(2.0**-50)).alias("x"),
    )
    blocks = op.range_blocks(df, ["g", "x"], 8)
    assert blocks.where("g = 'true'").select("__block").distinct().count() >= 5
    got = op.peer_percentile(df, {"p": "x"}, ["g"], ["id"], 6, null_metric, parts=8)
    plain = op.peer_percentile(df, {"p": "x"}, ["g"], ["id"], 6, null_metric, small_groups=True)
    assert got.count() == 3_000 and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    assert got.select("id").distinct().count() == 3_000
