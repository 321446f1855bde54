"""Reports kept up by day, and the append-and-compact stream sink."""

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quotelake import sources as src
from quotelake import streaming
from quotelake.catalog import roles
from quotelake.plans import flow, jobs
from tests.conftest import SF, rows

AS_OF = datetime.fromisoformat(roles.AS_OF)


def same(one, other):
    other = other.select(one.columns)
    return one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_flow_leaves_are_kept_by_day(spark, tmp_path, monkeypatch):
    prints = roles.flow_prints(spark, SF)
    # Prints repeat, and one day comes later than the others.
    prints = prints.union(prints.where("dtls_side = 'A'"))
    dated = prints.withColumn("file_version_date", F.date_format(F.to_date("flow_imp_dt", "MM/dd/yyyy"), "yyyyMMdd"))
    raw, store = str(tmp_path / "raw"), str(tmp_path / "leaves")
    newest = f"{AS_OF:%Y%m%d}"
    src.write_partitions(dated.where(F.col("file_version_date") != newest), raw)
    days = flow.refresh_leaves(spark, raw, store)
    assert len(days) > 45 and newest not in days
    src.write_partitions(dated.where(F.col("file_version_date") == newest), raw)
    read = []
    plain = jobs.read_partitioned
    monkeypatch.setattr(jobs, "read_partitioned", lambda s, path, col, values: read.append(list(values)) or plain(s, path, col, values))
    assert flow.refresh_leaves(spark, raw, store) == [newest] and read == [[newest]]
    assert flow.refresh_leaves(spark, raw, store) == [] and read == [[newest]]
    for as_of in (AS_OF, AS_OF - timedelta(days=5)):
        opened = flow.stored_leaves(spark, store, as_of)
        first = f"{as_of - timedelta(days=flow.LOOK_BACK_DAYS):%Y%m%d}"
        assert all(first <= f.split("file_version_date=")[1][:8] <= f"{as_of:%Y%m%d}" for f in opened.inputFiles())
        assert same(flow.stored_contract_stats(spark, store, as_of), flow.flow_contract_stats(flow.flow_prints_clean(prints, as_of)))
        assert same(flow.stored_open_interest(spark, store, as_of), flow.open_interest_history(prints, as_of))
    gone = flow.age_out(spark, store, AS_OF)
    assert gone and len(gone) + len(src.list_partitions(spark, store)) == len(days) + 1
    assert same(flow.stored_open_interest(spark, store, AS_OF), flow.open_interest_history(prints, AS_OF))


def test_flow_stats_reads_the_prints_once(spark, tmp_path):
    prints = roles.flow_prints(spark, SF)
    folder = str(tmp_path / "prints")
    prints.write.parquet(folder)
    plan = flow.flow_leaves(spark.read.parquet(folder))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def batch(spark, date, first, n):
    return spark.range(first, first + n).select("id", F.lit(date).alias("file_version_date"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_stream_sink_appends_and_compacts(spark, tmp_path):
    target = str(tmp_path / "raw")
    seen = {}
    for i in range(6):
        streaming.append_batch(batch(spark, "20250102", 10 * i, 10), i, target)
        files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{target}/file_version_date=*/*/*.parquet")}
        # No file of an earlier batch is written again: bytes grow with what came.
        assert all(files[f] == at for f, at in seen.items()) and len(files) == i + 1
        seen = files
    streaming.append_batch(batch(spark, "20250103", 900, 5), 6, target)
    # A batch that is repeated changes nothing.
    streaming.append_batch(batch(spark, "20250102", 50, 10), 5, target)
    assert ids(streaming.read_committed(spark, target)) == [*range(60), *range(900, 905)]
    assert ids(src.read_partitioned(spark, target, values=["20250102"])) == [*range(60)]
    assert streaming.compact(spark, target, most=5) == ["20250102"]
    assert streaming.committed_batches(spark, target) == {"20250102": ["0-5"], "20250103": ["6"]}
    assert ids(streaming.read_committed(spark, target)) == [*range(60), *range(900, 905)] == ids(src.read_partitioned(spark, target))
    streaming.append_batch(batch(spark, "20250102", 60, 3), 7, target)
    assert ids(streaming.read_committed(spark, target, ["20250102"])) == [*range(63)]
    assert streaming.compact(spark, target, most=1) == ["20250102"] and streaming.compact(spark, target) == []
    assert streaming.committed_batches(spark, target, ["20250102"]) == {"20250102": ["0-7"]}


def test_readers_pass_over_what_a_broken_compaction_left(spark, tmp_path):
    target = str(tmp_path / "raw")
    for i in range(3):
        streaming.append_batch(batch(spark, "20250102", 10 * i, 10), i, target)
    merged = src.read_partitioned(spark, target).withColumn("ingest_batch", F.lit("0-2"))
    streaming.ingest._write(merged, target, "file_version_date")
    assert len(src.list_partitions(spark, f"{target}/file_version_date=20250102", "ingest_batch")) == 4
    assert ids(streaming.read_committed(spark, target)) == [*range(30)]
    assert streaming.compact(spark, target) == [] and ids(src.read_partitioned(spark, target)) == [*range(30)]


@pytest.mark.parametrize("values", [None, ["20250102"]])
def test_no_batches(spark, tmp_path, values):
    target = str(tmp_path / "raw")
    streaming.append_batch(batch(spark, "20250101", 0, 2), 0, target)
    found = streaming.read_committed(spark, target, [] if values is None else values)
    assert found.collect() == [] and "id" in found.columns
