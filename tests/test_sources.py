import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake import operators as op
from quotelake import sources as src
from quotelake.plans import feeds, fundamentals, ingest
from quotelake.plans.jobs import PartitionedJob
from quotelake.sources.schemas import (
    BASE_TABLES,
    RATINGS_RENAMES,
    SCREENER_FIELDS,
    TRENDING_FIELDS,
    base_table_schema,
)
from quotelake.streaming import stream_csv_to_raw
from tests.conftest import one, rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_build_raw_new_dates_only(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "raw")
    write(landing / "flow_2025-01-02.csv", 'sym,n\nA,007\n"B ""x"", y",\n')
    ingest.build_raw(spark, str(landing), target)
    got = rows(src.read_partitioned(spark, target), "sym")
    assert [(r["sym"], r["n"], r["file_version_date"]) for r in got] == [
        ("A", "007", "20250102"),
        ('B "x", y', None, "20250102"),
    ]
    assert len({r["rowid"] for r in got}) == 2
    write(landing / "flow_2025-01-02.csv", "sym,n\nCHANGED,1\n")
    write(landing / "flow_2025-01-03.csv", "sym,n\nC,1\n")
    ingest.build_raw(spark, str(landing), target)
    assert sorted(r["sym"] for r in rows(src.read_partitioned(spark, target))) == ["A", 'B "x", y', "C"]
    ingest.build_raw(spark, str(landing), target, rerun=["20250102"])
    assert sorted(r["sym"] for r in rows(src.read_partitioned(spark, target))) == ["C", "CHANGED"]
    assert src.list_partitions(spark, target) == ["20250102", "20250103"]
    assert src.latest_partition(spark, target) == "20250103"
    assert [r["sym"] for r in rows(src.read_partitioned(spark, target, values=["20250103"]))] == ["C"]


def test_stage_csv_renames_and_fills(spark, tmp_path):
    write(tmp_path / "in" / "ratings_20250101.csv", "Ticker,Price,More\nA,,x\n")
    ingest.stage_csv(spark, str(tmp_path / "in"), str(tmp_path / "stage"), RATINGS_RENAMES)
    got = one(src.read_partitioned(spark, str(tmp_path / "stage")))
    assert got == {"symbol": "A", "targets": "", "More": "x", "file_version_date": "20250101"}


def test_stage_json_declared_schema(spark, tmp_path):
    data = [{"symbol": f"S{i}", "price": i, "unknown": 1, "sector": None} for i in range(3)]
    write(tmp_path / "in" / "screener_20250105.json", json.dumps(data))
    ingest.stage_json(spark, str(tmp_path / "in"), str(tmp_path / "stage"), SCREENER_FIELDS)
    got = rows(src.read_partitioned(spark, str(tmp_path / "stage")), "autonum")
    assert [r["autonum"] for r in got] == [0, 1, 2] and got[1]["price"] == "1"
    assert got[0]["sector"] == "" and got[0]["atr"] == "" and "unknown" not in got[0]
    assert len(SCREENER_FIELDS) == 87 and len(TRENDING_FIELDS) == 17


def test_dense_row_id_over_split_files(spark, tmp_path):
    for name in ("a", "b"):
        write(tmp_path / f"{name}.csv", "v\n" + "\n".join(f"{name}{i:05d}" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = src.read_csv_strings(spark, str(tmp_path), date_col=None)
        assert df.rdd.getNumPartitions() > 4
        got = src.with_dense_row_id(df).where(F.concat(F.substring("v", 1, 1), F.lpad(F.col("rowid").cast("string"), 5, "0")) != F.col("v"))
        assert got.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_rename_map_with_byte_order_mark(spark, tmp_path):
    path = write(tmp_path / "map.csv", "﻿current_column,new_column\nP/E,pe\n")
    assert src.read_rename_map(spark, path) == {"P/E": "pe"}


def test_declared_types():
    schema = src.string_schema([{"name": "a", "type": "double", "nullable": False}, {"name": "b", "type": "odd"}, "c"])
    assert [f.dataType.simpleString() for f in schema] == ["double", "string", "string"]
    assert not schema["a"].nullable
    assert all(base_table_schema(name).fields for name in BASE_TABLES)


def test_earnings_envelope(spark, tmp_path):
    reported = {"earningsDates": [{"Symbol": "A", "ActualEPS": 1.5, "EarningsDate": "d1"}, {"Symbol": "B"}]}
    upcoming = {"earningsDates": [{"Symbol": "B", "EarningsDate": "d2", "EarningsType": "x"}, {"Symbol": "C"}]}
    r = write(tmp_path / "reported_earnings_20250101.json", json.dumps(reported))
    u = write(tmp_path / "future_earnings_20250101.json", json.dumps(upcoming))
    row = src.string_schema(feeds.REPORTED_EARNINGS)
    left = src.read_envelope_rows(spark, r, "earningsDates", row)
    right = src.read_envelope_rows(spark, u, "earningsDates", src.string_schema(list(feeds.UPCOMING_EARNINGS)))
    assert one(left.where("Symbol = 'A'"))["file_version_date"] == "20250101"
    got = {x["Symbol"]: x for x in rows(feeds.earnings_calendar(left, right))}
    assert set(got) == {"A", "B", "C"} and len(got["A"]) == 15
    assert got["A"]["ActualEPS"] == "1.5" and got["A"]["Upcoming_EarningsDate"] is None
    assert got["B"]["Upcoming_EarningsDate"] == "d2" and got["B"]["EarningsDate"] is None
    with pytest.raises(ValueError, match="without Symbol"):
        feeds.earnings_calendar(left.drop("Symbol"), right)


def test_technical_rank_files(spark, tmp_path):
    large = [{"date": "2025-02-05"}, {"symbol": "A", "SCTR": 99.5, "odd": 1}]
    etf = [{}, {"symbol": "E", "close": 1}]
    row = src.string_schema(feeds.TECHNICAL_COLUMNS[1:10])
    frames = {}
    for name, data in {"largecap": large, "etf": etf}.items():
        path = write(tmp_path / f"{name}_sctr_report_20250205.json", json.dumps(data))
        frames[name] = src.read_header_rows(spark, path, row)
    got = {r["symbol"]: r for r in rows(feeds.technical_rank(frames))}
    assert got["A"]["marketcaptype"] == "large" and got["A"]["SCTR"] == "99.5"
    assert got["E"]["date"] == "2025-02-05" and got["E"]["file_version_date"] == "20250205"
    assert list(got["A"]) == feeds.TECHNICAL_COLUMNS


def test_analyst_scores_files(spark, tmp_path):
    data = [{"ticker": "A", "analystConsensus": {"consensus": "buy", "distribution": {"buy": 3, "hold": 1, "sell": 0}}}]
    extra = [{"ticker": "A", "research": {"tipRanksScore": None, "priceTarget": 10.5}}, {"ticker": "Z"}]
    d = write(tmp_path / "data_20250101.json", json.dumps(data))
    e = write(tmp_path / "extradata_20250101.json", json.dumps(extra))
    got = one(
        feeds.analyst_scores(
            src.read_json_envelope(spark, d, feeds.ANALYST_SCHEMA, "file_version_date"),
            src.read_json_envelope(spark, e, feeds.RESEARCH_SCHEMA, "file_version_date"),
        )
    )
    assert got["buy_count"] == 3 and got["tipRanksScore"] == 0 and got["tr_avg_price_target"] == 10.5
    assert got["tr_low_pricetarget"] is None and got["file_version_date"] == "20250101"


def test_bars_clock_edges(spark, tmp_path):
    # 13:29, 13:30, 20:00:59 and 20:01 UTC on a daylight day; 14:30 UTC in winter.
    stamps = [1741699740000, 1741699800000, 1741723259000, 1741723260000, 1736519400000]
    results = [{"t": t, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10} for t in stamps]
    path = write(tmp_path / "bars.json", json.dumps({"results": results}))
    envelope = src.read_json_envelope(spark, path, feeds.BARS_SCHEMA)
    got = rows(feeds.intraday_bars(feeds.bars_from_envelope(envelope)), "date")
    assert [(r["date"], r["regular_trading"]) for r in got] == [
        ("2025-01-10 09:30:00-0500", "Y"),
        ("2025-03-11 09:29:00-0400", "N"),
        ("2025-03-11 09:30:00-0400", "Y"),
        ("2025-03-11 16:00:59-0400", "Y"),
        ("2025-03-11 16:01:00-0400", "N"),
    ]


def _double(events):
    return events.select((F.col("v").cast("int") * 2).alias("v2"), "file_version_date")


def test_partitioned_job(spark, tmp_path):
    raw, target = str(tmp_path / "raw"), str(tmp_path / "stage")
    frame = spark.createDataFrame([("1", "20250101"), ("2", "20250102")], "v string, file_version_date string")
    src.write_partitions(frame, raw)
    job = PartitionedJob({"events": raw}, _double, target, ledger=str(tmp_path / "ledger"))
    assert job.run(spark) == ["20250101", "20250102"]
    assert job.run(spark) == []
    more = spark.createDataFrame([("bad", "20250103"), ("4", "20250104")], "v string, file_version_date string")
    src.write_partitions(more, raw)
    assert job.run(spark) == ["20250104"] and job.failed == ["20250103"]
    before = rows(src.read_partitioned(spark, target), "file_version_date")
    assert job.run(spark, rerun=["20250101"]) == ["20250101"]
    assert rows(src.read_partitioned(spark, target), "file_version_date") == before
    assert [r["v2"] for r in before] == [2, 4, 8]


def test_pending_partitions(spark):
    source = spark.createDataFrame([("1",), ("2",), ("2",)], "file_version_date string")
    done = spark.createDataFrame([("1",)], "file_version_date string")
    assert [r[0] for r in src.pending_partitions(source, done).collect()] == ["2"]
    assert [r[0] for r in src.pending_partitions(source, done, rerun=["1"]).collect()] == ["1"]
    assert src.pending_values(["1", "2"], ["1"]) == ["2"] and src.pending_values(["1", "2"], [], ["2"]) == ["2"]


def test_append_and_gzip(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(3)
    src.write_table(df, path, compression="gzip")
    src.append_table(df, path)
    assert spark.read.parquet(path).count() == 6
    src.write_table(df, path)
    assert spark.read.parquet(path).count() == 3


def test_stream_takes_only_new_files(spark, tmp_path):
    landing, target, checkpoint = (str(tmp_path / n) for n in ("in", "raw", "cp"))
    schema = src.string_schema(["sym"])
    write(tmp_path / "in" / "f_2025-01-02.csv", "sym\nA\n")
    stream_csv_to_raw(spark, landing, schema, target, checkpoint)
    write(tmp_path / "in" / "f_2025-01-03.csv", "sym\nB\n")
    stream_csv_to_raw(spark, landing, schema, target, checkpoint)
    stream_csv_to_raw(spark, landing, schema, target, checkpoint)
    got = rows(src.read_partitioned(spark, target), "sym")
    assert [(r["sym"], r["file_version_date"]) for r in got] == [("A", "20250102"), ("B", "20250103")]


def test_files_are_read_by_their_own_header(spark, tmp_path):
    write(tmp_path / "in/feed_20250101.csv", "sym,price\nA,1\n")
    write(tmp_path / "in/feed_20250102.csv", 'price,sym,"no, te"\n2,B,x\n')
    write(tmp_path / "in/feed_20250103.csv", "")
    ingest.build_raw(spark, str(tmp_path / "in"), str(tmp_path / "raw"))
    found = rows(src.read_partitioned(spark, str(tmp_path / "raw")), "sym")
    assert [(r["sym"], r["price"], r["no, te"], r["file_version_date"]) for r in found] == [
        ("A", "1", None, "20250101"),
        ("B", "2", "x", "20250102"),
    ]


def test_rows_that_do_not_fit_fail_loudly(spark, tmp_path):
    write(tmp_path / "in/feed_20250101.csv", 'sym,note\nA,"two\nlines"\n')
    write(tmp_path / "in/feed_20250102.csv", "sym,note\nB,one\n")
    target = str(tmp_path / "raw")
    assert ingest.build_raw(spark, str(tmp_path / "in"), target) == ["20250102"]
    assert ingest.build_raw(spark, str(tmp_path / "in"), target, multiline=True) == ["20250101"]
    assert {r["note"] for r in rows(src.read_partitioned(spark, target))} == {"two\nlines", "one"}
    write(tmp_path / "twice/feed_20250101.csv", "a,a\n1,2\n")
    assert ingest.build_raw(spark, str(tmp_path / "twice"), str(tmp_path / "raw2")) == []


def test_a_bad_date_costs_few_writes(spark, tmp_path):
    days = [f"2025010{i}" for i in range(1, 9)]
    data = spark.createDataFrame([(d, "x" if d == days[5] else "1") for d in days], "file_version_date string, v string")
    src.write_partitions(data, str(tmp_path / "raw"))
    job = PartitionedJob(
        {"rows": str(tmp_path / "raw")}, lambda rows: rows.withColumn("v", F.col("v").cast("int")), str(tmp_path / "stage")
    )
    assert job.run(spark) == [d for d in days if d != days[5]]
    assert job.failed == [days[5]] and job.writes <= 7
    assert job.run(spark) == []


def test_json_stage_opens_pending_files_only(spark, tmp_path):
    for day in ("20250101", "20250102"):
        write(tmp_path / f"in/feed_{day}.json", '[{"id":"%s"},{"id":"b"}]' % day)
    target = str(tmp_path / "stage")
    assert len(ingest.stage_json(spark, str(tmp_path / "in"), target, ["id"])) == 2
    write(tmp_path / "in/feed_20250101.json", "not json at all")
    write(tmp_path / "in/feed_20250103.json", '[{"id":"c"}]')
    assert ingest.stage_json(spark, str(tmp_path / "in"), target, ["id"]) == ["20250103"]
    assert {(r["id"], r["autonum"]) for r in rows(src.read_partitioned(spark, target))} == {
        ("20250101", 0), ("20250102", 0), ("b", 1), ("c", 0),
    }


def test_feeds_are_staged_by_date(spark, tmp_path):
    write(tmp_path / "r/e_20250101.json", '{"earningsDates":[{"Symbol":"A","ActualEPS":"1"}]}')
    write(tmp_path / "r/e_20250102.json", '{"earningsDates":[{"Symbol":"A","ActualEPS":"2"}]}')
    write(tmp_path / "u/e_20250101.json", '{"earningsDates":[{"Symbol":"A","EarningsDate":"2025-02-01"},{"Symbol":"B"}]}')
    target = str(tmp_path / "earnings")
    assert ingest.stage_earnings(spark, str(tmp_path / "r"), str(tmp_path / "u"), target) == ["20250101", "20250102"]
    found = {(r["Symbol"], r["file_version_date"], r["ActualEPS"], r["Upcoming_EarningsDate"]) for r in rows(src.read_partitioned(spark, target))}
    assert found == {
        ("A", "20250101", "1", "2025-02-01"), ("B", "20250101", None, None), ("A", "20250102", "2", None)
    }
    write(tmp_path / "c/t_20250101.json", '[{"ticker":"A","analystConsensus":{"consensus":"buy","distribution":{"buy":3}}}]')
    write(tmp_path / "c/t_20250102.json", '[{"ticker":"A"}]')
    write(tmp_path / "s/t_20250101.json", '[{"ticker":"A","research":{"tipRanksScore":7}}]')
    scores = str(tmp_path / "scores")
    assert ingest.stage_analyst_scores(spark, str(tmp_path / "c"), str(tmp_path / "s"), scores) == ["20250101"]
    assert one(src.read_partitioned(spark, scores))["tipRanksScore"] == 7
    write(tmp_path / "large/x_20250101.json", '[{"date":"2025-01-01"},{"symbol":"L","SCTR":"9"}]')
    write(tmp_path / "etf/x_20250101.json", '[{},{"symbol":"F"}]')
    ranks = str(tmp_path / "ranks")
    classes = {"largecap": str(tmp_path / "large"), "etf": str(tmp_path / "etf")}
    assert ingest.stage_technical_rank(spark, classes, ranks) == ["20250101"]
    assert {(r["symbol"], r["date"], r["marketcaptype"]) for r in rows(src.read_partitioned(spark, ranks))} == {
        ("L", "2025-01-01", "large"), ("F", "2025-01-01", "etf"),
    }


def test_stream_keeps_every_file_of_a_date(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("sym", "price")])
    for name, row in (("a", "A,1"), ("b", "B,2")):
        write(tmp_path / f"in/{name}_2025-01-02.csv", f"sym,price\n{row}\n")
        stream_csv_to_raw(spark, str(tmp_path / "in"), schema, str(tmp_path / "raw"), str(tmp_path / "check"))
    assert {r["sym"] for r in rows(src.read_partitioned(spark, str(tmp_path / "raw")))} == {"A", "B"}


def test_the_latest_date_opens_one_folder(spark, tmp_path):
    days = [("2025010%d" % i, f"T{i}", "f", "Stock") for i in range(1, 6)]
    data = spark.createDataFrame(days, "file_version_date string, ticker string, is_index string, issue_type string")
    src.write_partitions(data, str(tmp_path / "t"))
    newest = src.read_latest(spark, str(tmp_path / "t"))
    assert len(newest.inputFiles()) == 1
    assert one(fundamentals.listed_stocks(newest))["ticker"] == "T5"


def test_fundamentals_from_file_to_types(spark, tmp_path):
    renames = src.schemas.FUNDAMENTAL_RENAMES
    assert len(renames) == 122 == len(set(renames.values()))
    names = {new: old for old, new in renames.items()}
    sample = {"percent": "1.5%", "magnitude": "2M", "volume": "3K", "number": "4", "date": "Jan 5, 2025"}
    columns = [c for c, kind in fundamentals.FUNDAMENTAL_KINDS.items() if c in names and kind in sample]
    assert len(columns) > 60
    header = ",".join(f'"{names[c]}"' for c in [*columns, "symbol"])
    row = ",".join(f'"{sample[fundamentals.FUNDAMENTAL_KINDS[c]]}"' for c in columns)
    write(tmp_path / "in/fd_20250105.csv", f"{header}\n{row},A\n")
    ingest.stage_csv(spark, str(tmp_path / "in"), str(tmp_path / "stage"), renames)
    staged = one(src.read_partitioned(spark, str(tmp_path / "stage")))
    assert staged["symbol"] == "A" and all(staged[c] == sample[fundamentals.FUNDAMENTAL_KINDS[c]] for c in columns)


def test_every_base_table_has_a_schema():
    assert len(src.schemas.BASE_TABLES) == 14
    assert src.schemas.base_table_schema("exchange_companies")["tags"].dataType == T.ArrayType(T.StringType())


def scans(node):
    """File scans of a plan that has run."""
    name = node.nodeName()
    if name == "AdaptiveSparkPlan":
        return scans(node.executedPlan())
    if "QueryStage" in name:
        return scans(node.plan())
    children = node.children()
    found = [s for i in range(children.size()) for s in scans(children.apply(i))]
    return found + ([node] if name.startswith("Scan parquet") else [])


def test_a_join_on_the_date_opens_the_joined_dates_only(spark, tmp_path):
    days = spark.range(40).selectExpr("CAST(20250101 + id AS STRING) AS file_version_date", "id AS n", "id % 7 AS kind")
    src.write_partitions(days, str(tmp_path / "large"))
    src.write_table(days.where("n < 8"), str(tmp_path / "asked"))
    asked = spark.read.parquet(str(tmp_path / "asked")).where("kind = 3").select("file_version_date")
    kept = op.keep_matching(src.read_partitioned(spark, str(tmp_path / "large")), asked, ["file_version_date"])
    joined = src.read_partitioned(spark, str(tmp_path / "large")).join(asked, "file_version_date")
    for df in (kept, joined):
        assert [r["n"] for r in df.collect()] == [3]
        opened = [
            s.metrics().apply("numFiles").value() for s in scans(df._jdf.queryExecution().executedPlan()) if "large" in s.toString()
        ]
        assert opened == [1]
