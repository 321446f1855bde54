"""What the steps of a job leave on disk, and how often wide rows are shuffled."""

import re
import time

from pyspark.sql import functions as F

from quotelake import sources as src
from quotelake.catalog import roles
from quotelake.plans import flow, jobs, summary
from quotelake.plans.jobs import PartitionedJob
from tests.conftest import SF, rows


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [held.apply(i).getName() for i in range(held.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    frame = spark.range(2000).selectExpr("id", "CAST(20250101 + id % 3 AS STRING) AS file_version_date")
    src.write_partitions(frame, str(tmp_path / "plain"))
    src.write_partitions(frame, str(tmp_path / "sorted"), sort_by=["id"])
    until = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    # The setting is that of the session again, and what is read can be read twice.
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    counted = src.read_partitioned(spark, str(tmp_path / "sorted")).groupBy("file_version_date").count()
    assert rows(counted, "file_version_date") == rows(counted, "file_version_date")
    assert sum(r["count"] for r in rows(counted)) == 2000


def test_large_dates_go_one_after_the_other(spark, tmp_path, monkeypatch):
    days = [f"2025010{i}" for i in range(1, 7)]
    data = [(d, "bad" if d == days[4] else str(n)) for n, d in enumerate(days)]
    src.write_partitions(spark.createDataFrame(data, "file_version_date string, v string"), str(tmp_path / "raw"))
    size = max(src.lake.partition_bytes(spark, str(tmp_path / "raw"), d) for d in days)
    assert size > 0 and src.lake.partition_bytes(spark, str(tmp_path / "raw"), "20250109") == 0
    loaded = []
    plain = jobs.read_partitioned
    monkeypatch.setattr(jobs, "read_partitioned", lambda s, path, col, values: loaded.append(list(values)) or plain(s, path, col, values))
    monkeypatch.setattr(jobs, "BYTES_AT_ONCE", 2 * size)
    job = PartitionedJob(
        {"rows": str(tmp_path / "raw")}, lambda rows: rows.withColumn("v", F.col("v").cast("int")), str(tmp_path / "stage")
    )
    assert job.run(spark) == [d for d in days if d != days[4]] and job.failed == [days[4]]
    assert loaded == [days[:2], days[2:4], days[4:], [days[4]], [days[5]]]
    assert [r["v"] for r in rows(src.read_partitioned(spark, str(tmp_path / "stage")), "v")] == [0, 1, 2, 3, 5]
    monkeypatch.setattr(jobs, "BYTES_AT_ONCE", 1)
    assert job.run(spark, rerun=days[:3]) == days[:3] and job.writes == 3


def shuffles(df):
    return re.findall(r"Exchange \w*partitioning\(.*", df._jdf.queryExecution().executedPlan().toString())


def test_prints_are_shuffled_once_for_their_leaves(spark, tmp_path):
    roles.flow_prints(spark, SF).write.parquet(str(tmp_path / "prints"))
    assert len(shuffles(flow.flow_leaves(spark.read.parquet(str(tmp_path / "prints"))))) == 1
    assert len(shuffles(flow.flow_leaves(roles.flow_prints(spark, SF)))) == 1


def test_rows_of_the_flow_report_are_not_shuffled_once_they_are_wide(spark):
    values = roles.attribute_values(roles.table(spark, SF, "supplier"), "s_suppkey", "S")
    about = summary.daily_ticker_summary(values, roles.attributes(spark), roles.companies(spark, SF, "supplier"))
    as_of = F.lit(roles.AS_OF).cast("timestamp_ntz")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = flow.flow_stats(roles.flow_prints(spark, SF), about, as_of)
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(r"\+- Window .*ask_vol_tse", line))
    above, depth = [], lines[at].index("Window")
    for line in reversed(lines[:at]):
        if (found := re.search(r"[A-Z]", line)).start() < depth:
            above.append(line)
            depth = found.start()
    assert sum("SortMergeJoin" in line for line in above) == 1 and not any("Exchange" in line for line in above)
