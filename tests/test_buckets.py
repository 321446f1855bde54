"""Bucketed stage tables: plans without shuffle, dates replaced, sessions with another catalog."""

import uuid

import pytest

from quotelake import sources as src
from quotelake.catalog import queries, roles
from quotelake.plans import trades
from quotelake.plans.jobs import BucketedJob
from tests.conftest import rows
from tests.test_products import oi_frame, trade, trade_frame

CHAINS = [f"SPY250310{kind}00{strike}000" for kind in "CP" for strike in (560, 565, 570, 575)]


def store(spark, path, frame, transform, name, buckets=4):
    src.write_partitions(frame, f"{path}/raw/{name}")
    table = src.BucketedTable(f"{name}_{uuid.uuid4().hex}", f"{path}/stage/{name}", trades.CHAIN_KEY, buckets)
    job = BucketedJob({name: f"{path}/raw/{name}"}, transform, table.path, table=table)
    return table, job


def trade_rows(spark):
    days = ["20250306", "20250307"]
    sides = [("ask", "slan"), ("bid", "mlet"), (None, "auto"), ("mid", "auto")]
    data = [
        trade(chain, side, code, size=str(20 + 7 * i + 3 * j), file_version_date=day)
        for day in days
        for i, chain in enumerate(CHAINS)
        for j, (side, code) in enumerate(sides)
    ]
    return trade_frame(spark, *data, trade(CHAINS[1], option_chain_id=None), trade(CHAINS[0], file_version_date="20250308"))


def oi_rows(spark):
    both = [oi_frame(spark, *CHAINS, file_version_date=day) for day in ("20250306", "20250307")]
    return both[0].unionByName(both[1])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_chain_steps_from_buckets_without_shuffle(spark, tmp_path):
    leaves, job = store(spark, tmp_path, trade_rows(spark), trades.chain_leaves, "trades")
    base, base_job = store(spark, tmp_path, oi_rows(spark), trades.keyed_chain_base, "oi_changes")
    assert job.run(spark) == ["20250306", "20250307", "20250308"] and base_job.run(spark) == ["20250306", "20250307"]
    assert job.run(spark) == []
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cube = trades.option_trades_of_leaves(leaves.read(spark), base.read(spark))
        assert "Exchange" not in plan(cube) and "SortMergeJoin" in plan(cube)
        staged = trades.chain_analytics(cube, base.read(spark), trades.CHAIN_KEY)
        # Only the windows over an expiry, above the joins, place rows anew.
        assert plan(staged).count("Exchange") == 1
        assert plan(staged).index("Exchange") < plan(staged).index("SortMergeJoin")
        found = rows(trades.chain_zscores(staged), "option_chain_id", "file_version_date")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    chains = trades.chain_base(oi_rows(spark))
    direct = trades.chain_analytics(trades.option_trades_by_chain(trade_rows(spark), chains), chains)
    assert len(found) == 2 * len(CHAINS)
    assert found == rows(trades.chain_zscores(direct), "option_chain_id", "file_version_date")


def test_a_date_written_anew_and_a_date_that_went_empty(spark, tmp_path):
    leaves, job = store(spark, tmp_path, trade_rows(spark), trades.chain_leaves, "trades")
    job.run(spark)
    before = leaves.read(spark).count()
    # The table brings the mode along: a session of another mode loses no date.
    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "static")
    try:
        replace_one_date(spark, tmp_path, leaves, job, before)
    finally:
        spark.conf.set(mode, "dynamic")


def replace_one_date(spark, tmp_path, leaves, job, before):
    src.write_partitions(trade_frame(spark, trade(CHAINS[0])), str(tmp_path / "raw/trades"))
    assert job.run(spark, rerun=["20250307"]) == ["20250307"]
    dates = {d: n for d, n in leaves.read(spark).groupBy("file_version_date").count().collect()}
    assert dates["20250307"] == 1 and sum(dates.values()) < before and len(dates) == 3
    leaves.replace(leaves.read(spark).where("file_version_date = 'none'"), ["20250307"])
    assert {r["file_version_date"] for r in rows(leaves.read(spark))} == {"20250306", "20250308"}


def test_buckets_are_one_file_a_date_and_open_again_under_another_name(spark, tmp_path):
    leaves, job = store(spark, tmp_path, trade_rows(spark), trades.chain_leaves, "trades")
    job.run(spark)
    files = list((tmp_path / "stage/trades").glob("file_version_date=20250306/*.parquet"))
    assert 1 < len(files) <= 4
    again = src.BucketedTable("again_" + uuid.uuid4().hex, leaves.path, leaves.by, leaves.buckets)
    again.create(spark, leaves.read(spark).schema)
    assert again.read(spark).count() == leaves.read(spark).count()


@pytest.mark.parametrize("bad_size", ["60", "many"])
def test_a_date_that_fails_is_not_left_out_of_the_zscores(spark, monkeypatch, bad_size):
    late = trade(CHAINS[0], size=bad_size, file_version_date="20250308")
    monkeypatch.setattr(roles, "option_trades", lambda *_: trade_rows(spark).union(trade_frame(spark, late)))
    monkeypatch.setattr(roles, "oi_changes", lambda *_: oi_rows(spark))
    if bad_size == "60":
        assert queries.chain_zscores_bucketed(spark, "").count() == 2 * len(CHAINS)
    else:
        with pytest.raises(RuntimeError, match="20250308"):
            queries.chain_zscores_bucketed(spark, "")
