"""What grows with the input: shuffles, and the rows that a task holds."""

import re

import pytest
from pyspark.sql import functions as F

from quotelake.catalog import roles
from quotelake.catalog.queries import chain_zscores, chain_zscores_bucketed, cube_distinct
from quotelake.operators import count_rows, cube_agg
from quotelake.plans import flow, summary, trades
from quotelake.session import partitions_for

from tests.conftest import SF


def shuffles(df):
    """The plan's exchanges by hash, range or number."""
    return re.findall(r"Exchange \w*partitioning\(.*", df._jdf.queryExecution().executedPlan().toString())


def test_trades_are_shuffled_once_for_the_cube(spark):
    cube = trades.option_trade_cube(roles.option_trades(spark, SF))
    assert len(shuffles(cube)) == 1


def test_trades_of_the_chains_are_shuffled_once_for_strike_totals(spark):
    base = trades.chain_base(roles.oi_changes(spark, SF))
    cube = trades.option_trades_by_chain(roles.option_trades(spark, SF), base)
    placed = [s for s in shuffles(cube) if "option_chain_id" in s and "REPARTITION" in s]
    assert len(placed) == 1 and not any("option_tx_type" in s for s in shuffles(cube))


def test_trades_without_chain_or_day_are_in_no_cube(spark):
    made = roles.option_trades(spark, SF).limit(300)
    holes = made.withColumn("option_chain_id", F.lit(None).cast("string")).unionByName(
        made.withColumn("file_version_date", F.lit(None).cast("string"))
    )
    cube = trades.option_trade_cube(made.unionByName(holes), min_size=0)
    assert cube.exceptAll(trades.option_trade_cube(made, min_size=0)).isEmpty()


def test_placed_cube_equals_the_combined_one(spark):
    rows = spark.range(500).selectExpr("id % 7 AS k", "if(id % 3 = 0, NULL, id % 3) AS a", "id % 4 AS b")
    plain = cube_agg(rows, ["k"], ["a", "b"], [count_rows("n")], grouping_col="g")
    placed = cube_agg(rows, ["k"], ["a", "b"], [count_rows("n")], distribute_by=["k"], grouping_col="g", partitions=9)
    assert placed.exceptAll(plain).isEmpty() and plain.exceptAll(placed).isEmpty()


@pytest.mark.parametrize("rows, wanted", [(0, 4), (400, 4), (401, 5), (1000, 10)])
def test_partitions_follow_the_rows(spark, rows, wanted):
    assert partitions_for(spark.range(rows), 100) == wanted


def test_attribute_values_are_not_shipped_by_attribute_name(spark):
    values = roles.attribute_values(roles.table(spark, SF, "customer"), "c_custkey", "C")
    wide = summary.daily_ticker_summary(values, roles.attributes(spark), roles.companies(spark, SF, "customer"))
    assert not any("columnname" in s for s in shuffles(wide))


def test_placements_that_widen_rows_are_not_coalesced(spark):
    as_of = F.lit(roles.AS_OF).cast("timestamp_ntz")
    stats = flow.flow_contract_stats(flow.flow_prints_clean(roles.flow_prints(spark, SF), as_of))
    for df in (stats, cube_distinct(spark, SF)):
        assert any("REPARTITION_BY_NUM" in s for s in shuffles(df))


def test_buckets_and_windows_of_the_chains_follow_the_rows(spark, monkeypatch):
    n = roles.option_trades(spark, SF).count()
    monkeypatch.setattr(trades, "TRADES_PER_BUCKET", -(-n // 11))
    monkeypatch.setattr(trades, "CONTRACTS_PER_TASK", 10**9)
    plan = chain_zscores_bucketed(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"SelectedBucketsCount: (\d+) out of \d+", plan)) == {"11"}
    # The windows are placed by number, so their tasks are not merged by compressed bytes.
    assert re.search(r"hashpartitioning\(file_version_date\S+ underlying_symbol\S+ expiry\S+ 4\), REPARTITION_BY_NUM", plan)


def test_windows_over_an_expiry_hold_a_bounded_number_of_trades(spark, monkeypatch):
    n = roles.option_trades(spark, SF).count()
    monkeypatch.setattr(trades, "TRADES_PER_TASK", -(-n // 13))
    assert any("expiry" in s and "13), REPARTITION_BY_NUM" in s for s in shuffles(chain_zscores(spark, SF)))
