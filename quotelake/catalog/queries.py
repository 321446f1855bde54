"""Every operator and product as a query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.catalog import roles
from quotelake.functions import (
    compact_date,
    first_replace,
    round_stable,
    title_case,
    try_bigint,
)
from quotelake.operators import (
    add_literal,
    attribute_pivot,
    conditional_pivot,
    cube_count_distinct,
    date_dimension,
    date_windows,
    days_spanned,
    first_record,
    full_outer_merge,
    latest_flag,
    latest_snapshot,
    peer_percentile,
    ranged_neighbours,
    share_of_partition,
    stack_frames,
    zscore,
)
from quotelake.plans import feeds, flow, fundamentals, ingest, master, screener, summary, trades
from quotelake.plans.jobs import BucketedJob, PartitionedJob, refresh_table
from quotelake.session import compile_wide_rows, partitions_for, shared_folder
from quotelake.sources import (
    BucketedTable,
    append_table,
    latest_partition,
    list_partitions,
    pending_partitions,
    read_csv_strings,
    read_latest,
    read_partitioned,
    with_dense_row_id,
    with_row_id,
    write_partitions,
    write_table,
)
from quotelake.sources.files import header_rows
from quotelake.sources.schemas import FUNDAMENTAL_RENAMES
from quotelake.streaming import stream_partitions

table = roles.table


def _as_of():
    return F.lit(roles.AS_OF).cast("timestamp_ntz")


def doubles(df: DataFrame) -> DataFrame:
    """Decimals and single floats as doubles, for comparison across engines."""
    wide = (T.DecimalType, T.FloatType)
    return df.select(
        *[F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, wide) else f.name for f in df.schema.fields]
    )


# --- option trades -------------------------------------------------------


def trade_cube(spark: SparkSession, sf: str) -> DataFrame:
    return trades.option_trade_cube(roles.option_trades(spark, sf))


def trade_cube_strict(spark: SparkSession, sf: str) -> DataFrame:
    return trades.option_trade_cube(roles.option_trades(spark, sf), strict=True)


def trade_cube_staged(spark: SparkSession, sf: str) -> DataFrame:
    """The cube as an incremental job writes it: raw trades by date to a sorted stage."""
    base = shared_folder(spark, "trades")
    write_partitions(roles.option_trades(spark, sf), f"{base}/raw")
    PartitionedJob(
        {"trades": f"{base}/raw"}, trades.option_trade_cube, f"{base}/stage", sort_by=trades.STAGE_ORDER
    ).run_whole(spark)
    return read_partitioned(spark, f"{base}/stage")


# Distinct lines that one task of ``cube_distinct`` multiplies by the grouping sets.
LINES_PER_TASK = 500_000


def cube_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct orders under CUBE: not additive, so Spark's own grouping sets."""
    keys = ["l_suppkey", "l_returnflag", "l_linestatus", "l_orderkey"]
    lines = table(spark, sf, "lineitem").select(*keys)
    # Reduced to distinct orders with a row count before the sets multiply them, as many in a task as its memory suits.
    placed = lines.repartition(partitions_for(lines, LINES_PER_TASK), *keys)
    leaves = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    leaves.createOrReplaceTempView("cube_distinct_leaves")
    return spark.sql(
        """
        SELECT l_suppkey, l_returnflag, l_linestatus,
               count(DISTINCT l_orderkey) AS orders, sum(n) AS rows_seen
        FROM cube_distinct_leaves
        GROUP BY l_suppkey, CUBE(l_returnflag, l_linestatus)
        """
    )


def cube_distinct_dense(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct orders by year of shipping under CUBE, as bitmaps: each year holds most order numbers of a range."""
    lines = table(spark, sf, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    return cube_count_distinct(lines, ["ship_year"], ["l_returnflag", "l_linestatus"], "l_orderkey", "orders")


def chain_base(spark: SparkSession, sf: str) -> DataFrame:
    return trades.chain_base(roles.oi_changes(spark, sf))


def option_trades_by_chain(spark: SparkSession, sf: str) -> DataFrame:
    return trades.option_trades_by_chain(roles.option_trades(spark, sf), chain_base(spark, sf))


def strike_details(spark: SparkSession, sf: str) -> DataFrame:
    return trades.strike_details(option_trades_by_chain(spark, sf))


def chain_analytics(spark: SparkSession, sf: str) -> DataFrame:
    # No more contracts than trades, which are counted from stored Parquet without reading a column.
    partitions = partitions_for(roles.option_trades(spark, sf), trades.TRADES_PER_TASK)
    return trades.chain_analytics(option_trades_by_chain(spark, sf), chain_base(spark, sf), partitions=partitions)


def chain_zscores(spark: SparkSession, sf: str) -> DataFrame:
    return trades.chain_zscores(chain_analytics(spark, sf))


def chain_zscores_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The ad-hoc form for one expiry, over all symbols."""
    base = trades.chain_base(roles.oi_changes(spark, sf), expiries=[20020315])
    cube = trades.option_trades_by_chain(roles.option_trades(spark, sf), base)
    return trades.chain_zscores(trades.chain_analytics(cube, base)).select(
        *trades.CONTRACT, *trades.CONTRACT_ZSCORES, *trades.STRIKE_ZSCORES
    )


def chain_store(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Trade leaves and open interest as jobs keep them, bucketed by chain and day; the later dates come second."""
    base = shared_folder(spark, "chains")
    raw = {
        "trades": (roles.option_trades(spark, sf), trades.chain_leaves),
        "oi_changes": (roles.oi_changes(spark, sf), trades.keyed_chain_base),
    }
    buckets = partitions_for(raw["trades"][0], trades.TRADES_PER_BUCKET)
    stored = []
    for name, (rows, transform) in raw.items():
        table_name = f"{name}_{base.rpartition('-')[2]}"
        staged = BucketedTable(table_name, f"{base}/stage/{name}", trades.CHAIN_KEY, buckets)
        job = BucketedJob({name: f"{base}/raw/{name}"}, transform, staged.path, table=staged)
        early = F.col("file_version_date") < "19970101"
        for delivery in (early, ~early):
            write_partitions(rows.where(delivery), f"{base}/raw/{name}")
            job.run_whole(spark)
        stored.append(staged.read(spark))
    return tuple(stored)


def chain_zscores_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Cube, analytics and z-scores from the bucketed stage tables."""
    compile_wide_rows(spark)
    leaves, base = chain_store(spark, sf)
    cube = trades.option_trades_of_leaves(leaves, base)
    partitions = partitions_for(base, trades.CONTRACTS_PER_TASK)
    return trades.chain_zscores(trades.chain_analytics(cube, base, trades.CHAIN_KEY, partitions))


def contract_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Conditional sums and maxima per part."""
    flag, value = F.col("l_returnflag"), F.col("l_quantity")
    spec = {f"qty_{f.lower()}": (F.sum, flag == f, value) for f in ("A", "R", "N")}
    spec |= {f"top_{f.lower()}": (F.max, flag == f, "l_extendedprice") for f in ("A", "R", "N")}
    spec["any_open"] = (F.bool_or, F.lit(True), F.col("l_linestatus") == "O")
    pivoted = conditional_pivot(table(spark, sf, "lineitem"), ["l_partkey"], spec)
    return pivoted.withColumn("any_open", F.when(F.col("any_open"), "Y").otherwise("N"))


# --- screener and score --------------------------------------------------


def screener_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return screener.screener_metrics(roles.option_screener(spark, sf))


def sweep_premium_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return screener.sweep_premium_rollup(roles.option_trades(spark, sf))


def option_screener(spark: SparkSession, sf: str) -> DataFrame:
    return screener.option_screener(screener_metrics(spark, sf), sweep_premium_rollup(spark, sf))


def symbol_master(spark: SparkSession, sf: str) -> DataFrame:
    return master.symbol_master(*roles.master_sources(spark, sf))


def composite_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = screener.composite_score(option_screener(spark, sf), symbol_master(spark, sf))
    return scored.select(
        "ticker", "file_version_date", "sector", *screener.percentile_metrics(), "options_composite_score"
    )


def customer_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Percent ranks in five segments that grow with the table."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"))
    rows = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    ranked = peer_percentile(
        rows, {"balance_pct": "c_acctbal", "orders_pct": "orders"}, ["c_mktsegment"], ["c_custkey"]
    )
    return ranked.select("c_custkey", "c_mktsegment", "balance_pct", "orders_pct")


def customer_percentiles_present(spark: SparkSession, sf: str) -> DataFrame:
    """The same without the customers that lack the metric."""
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("spent")
    )
    counts = counts.withColumn("spent", round_stable("spent", 2))
    rows = table(spark, sf, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left")
    ranked = peer_percentile(
        rows, {"spent_pct": "spent"}, ["c_mktsegment"], ["c_custkey"], null_metric="ignore"
    )
    return ranked.select("c_custkey", "c_mktsegment", "spent_pct")


def golden_record(spark: SparkSession, sf: str) -> DataFrame:
    """The first party per nation, customers before suppliers."""
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"),
        F.lit(1).alias("priority"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("segment"),
        F.col("c_name").alias("name"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"),
        F.lit(2).alias("priority"),
        F.lit(None).cast("string").alias("segment"),
        F.col("s_name").alias("name"),
    )
    return first_record(
        customers.unionByName(suppliers), "nation", ["priority", "segment"], "name", "max_name"
    )


# --- typed vendor text ---------------------------------------------------


def fundamentals_typed(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(fundamentals.fundamentals_typed(roles.fundamentals(spark, sf)))


def fundamentals_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same from daily CSV files under the vendor's headers, staged by the rename map."""
    base = shared_folder(spark, "fundamentals")
    headers = {name: header for header, name in FUNDAMENTAL_RENAMES.items()}
    rows = roles.fundamentals(spark, sf)
    day = F.concat(F.lit("2025010"), (F.crc32("symbol") % 5 + 1).cast("string")).alias("file_version_date")
    _deliver(rows.select(*[F.col(c).alias(headers.get(c, c)) for c in rows.columns], day), f"{base}/in", "csv")
    ingest.stage_csv(spark, f"{base}/in", f"{base}/stage", FUNDAMENTAL_RENAMES)
    return doubles(fundamentals.fundamentals_typed(read_partitioned(spark, f"{base}/stage")))


def ratings_typed(spark: SparkSession, sf: str) -> DataFrame:
    return fundamentals.ratings_typed(roles.ratings(spark, sf))


def ticker_universe(spark: SparkSession, sf: str) -> DataFrame:
    """From the stored screener's newest date; no other folder is opened."""
    stored = shared_folder(spark, "universe")
    write_partitions(roles.option_screener(spark, sf), stored)
    return fundamentals.listed_stocks(read_latest(spark, stored))


def universe_screen(spark: SparkSession, sf: str) -> DataFrame:
    typed = fundamentals.fundamentals_typed(roles.fundamentals(spark, sf))
    return doubles(fundamentals.universe_screen(typed).select("symbol", "option_short", "avgvolume", "price"))


def text_functions(spark: SparkSession, sf: str) -> DataFrame:
    """First-match replacement, title case and number parsing on whole texts."""
    words = F.split("text", " ")
    return table(spark, sf, "documents").select(
        "doc_id",
        F.md5(title_case("text")).alias("title_md5"),
        F.md5(first_replace("text", "e", "#")).alias("first_md5"),
        try_bigint(F.concat(F.col("n_chars").cast("string"), F.lit(".5"))).alias("rounded_up"),
        try_bigint(F.get(words, 0)).alias("not_a_number"),
    )


# --- JSON feeds ----------------------------------------------------------


def analyst_scores(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.analyst_scores(*roles.analyst_feeds(spark, sf))


def earnings_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.earnings_calendar(*roles.earnings(spark, sf))


def technical_rank(spark: SparkSession, sf: str) -> DataFrame:
    files = roles.technical_files(spark, sf)
    row = T.StructType([T.StructField(c, T.StringType()) for c in ("symbol", "SCTR", "vol", "name")])
    rows = header_rows(files, "value", row, keep=["file_version_date", "class"])
    headers = files.select("file_version_date", F.get_json_object("value", "$[0].date").alias("date"))
    return feeds.rank_rows(rows, headers)


def intraday_bars(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.intraday_bars(roles.bars(spark, sf), keep=["event_id"])


def session_volume(spark: SparkSession, sf: str) -> DataFrame:
    """Bars aggregated by their session flag and local day."""
    rows = feeds.intraday_bars(roles.bars(spark, sf))
    return rows.groupBy(F.substring("date", 1, 10).alias("local_day"), "regular_trading").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"), F.max("high").alias("high")
    )


# --- flow ----------------------------------------------------------------


def flow_prints_clean(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(flow.flow_prints_clean(roles.flow_prints(spark, sf), _as_of()))


def flow_prints_after_close(spark: SparkSession, sf: str) -> DataFrame:
    """Clean prints on an expiry day once trading has ended: contracts of that day are gone."""
    as_of = F.lit(roles.AFTER_CLOSE).cast("timestamp_ntz")
    return doubles(flow.flow_prints_clean(roles.flow_prints(spark, sf), as_of, after_close=True))


def flow_contract_stats(spark: SparkSession, sf: str) -> DataFrame:
    compile_wide_rows(spark)
    clean = flow.flow_prints_clean(roles.flow_prints(spark, sf), _as_of())
    return doubles(flow.flow_contract_stats(clean))


def open_interest_history(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(flow.open_interest_history(roles.flow_prints(spark, sf), _as_of()))


def flow_store(spark: SparkSession, sf: str) -> tuple[str, datetime]:
    """Leaves kept by day, the last three days of prints delivered after the others."""
    compile_wide_rows(spark)
    base = shared_folder(spark, "flow")
    prints = roles.flow_prints(spark, sf)
    day = F.date_format(F.to_date("flow_imp_dt", "MM/dd/yyyy"), "yyyyMMdd")
    prints = prints.withColumn("file_version_date", day)
    as_of = datetime.fromisoformat(roles.AS_OF)
    late = f"{as_of - timedelta(days=3):%Y%m%d}"
    for delivery in (F.col("file_version_date") < late, F.col("file_version_date") >= late):
        write_partitions(prints.where(delivery), f"{base}/prints")
        flow.refresh_leaves(spark, f"{base}/prints", f"{base}/leaves")
    flow.age_out(spark, f"{base}/leaves", as_of)
    return f"{base}/leaves", as_of


def flow_stats_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Contract statistics from leaves that were kept and added to by day."""
    return doubles(flow.stored_contract_stats(spark, *flow_store(spark, sf)))


def open_interest_incremental(spark: SparkSession, sf: str) -> DataFrame:
    return doubles(flow.stored_open_interest(spark, *flow_store(spark, sf)))


def daily_ticker_summary(spark: SparkSession, sf: str) -> DataFrame:
    values = roles.attribute_values(table(spark, sf, "customer"), "c_custkey", "C")
    return summary.daily_ticker_summary(
        values, roles.attributes(spark), roles.companies(spark, sf, "customer")
    )


def flow_stats(spark: SparkSession, sf: str) -> DataFrame:
    compile_wide_rows(spark)
    values = roles.attribute_values(table(spark, sf, "supplier"), "s_suppkey", "S")
    about = summary.daily_ticker_summary(
        values, roles.attributes(spark), roles.companies(spark, sf, "supplier")
    )
    return doubles(flow.flow_stats(roles.flow_prints(spark, sf), about, _as_of()))


def order_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """Previous, next and latest daily order value per customer."""
    daily = (
        table(spark, sf, "orders")
        .groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
        .agg(F.sum(F.floor("o_totalprice")).alias("value"))
    )
    return ranged_neighbours(daily, ["o_custkey"], ["day"], "value")


def return_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each supplier's quantity by return flag, on every line."""
    shares = {
        f"share_{f.lower()}": (F.col("l_returnflag") == f, F.col("l_quantity")) for f in ("A", "R", "N")
    }
    rows = share_of_partition(table(spark, sf, "lineitem"), ["l_suppkey"], shares)
    return rows.select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", *shares)


def order_zscores(spark: SparkSession, sf: str) -> DataFrame:
    """Z-scores in five priority groups that grow with the table."""
    rows = zscore(table(spark, sf, "orders"), {"price_z": "o_totalprice"}, ["o_orderpriority"])
    return rows.select("o_orderkey", "o_orderpriority", "price_z")


def attribute_values_pivot(spark: SparkSession, sf: str) -> DataFrame:
    """Event values by type as columns, the greatest per user."""
    events = table(spark, sf, "events")
    return attribute_pivot(events, "user_id", "event_type", "value", ["click", "error", "purchase", "signup", "view"])


# --- calendar, sets and snapshots ----------------------------------------


def calendar_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar columns of each order date."""
    return date_dimension(table(spark, sf, "orders"), "o_orderdate")


def calendar_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """A correlated scalar subquery against the calendar, in the select list
    and inside a window's order."""
    calendar_of_orders(spark, sf).createOrReplaceTempView("lookup_calendar")
    table(spark, sf, "orders").createOrReplaceTempView("lookup_orders")
    return spark.sql(
        """
        SELECT DISTINCT o_orderpriority, week_close,
               dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY week_close) AS week_rank
        FROM (
          SELECT DISTINCT o_orderpriority,
                 (SELECT max(c.last_day_of_week) FROM lookup_calendar c
                  WHERE c.actualdate = CAST(o.o_orderdate AS DATE)) AS week_close
          FROM lookup_orders o
        )
        """
    )


def customer_date_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Fetch windows of at most 70 days over each customer's order history."""
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("start"), F.max("o_orderdate").alias("end")
    )
    return date_windows(spans, keep=["o_custkey"])


def newest_orders(spark: SparkSession, sf: str) -> DataFrame:
    return latest_snapshot(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "o_custkey")


def newest_flag(spark: SparkSession, sf: str) -> DataFrame:
    flagged = latest_flag(table(spark, sf, "orders"), "o_orderdate", "newest")
    return flagged.groupBy("newest").agg(F.count(F.lit(1)).alias("orders"))


def pending_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Ship dates on which nothing was ordered."""
    shipped = table(spark, sf, "lineitem").select(compact_date("l_shipdate").alias("file_version_date"))
    ordered = table(spark, sf, "orders").select(compact_date("o_orderdate").alias("file_version_date"))
    return pending_partitions(shipped, ordered)


def part_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Intersection and difference of the part-supplier pairs per flag."""
    lines = table(spark, sf, "lineitem")

    def pairs(flag: str) -> DataFrame:
        return lines.where(F.col("l_returnflag") == flag).select("l_partkey", "l_suppkey")

    both = pairs("A").intersect(pairs("R")).withColumn("found", F.lit("A and R"))
    only = pairs("N").subtract(pairs("A")).withColumn("found", F.lit("N not A"))
    return both.unionByName(only)


def party_stack(spark: SparkSession, sf: str) -> DataFrame:
    """Frames of different columns stacked, then distinct names per nation."""
    customers = table(spark, sf, "customer").select(
        F.col("c_nationkey").alias("nation"), "c_mktsegment", F.col("c_acctbal").alias("balance")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    )
    parties = stack_frames([customers, suppliers])
    return parties.groupBy("nation", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("parties"), F.max("balance").alias("best"), F.min("balance").alias("worst")
    )


def full_outer_parties(spark: SparkSession, sf: str) -> DataFrame:
    """Customers' and suppliers' greatest balance by nation and by balance band."""

    def banded(name: str, balance: str, out: str) -> DataFrame:
        band = F.floor(F.col(balance) / 50).cast("bigint").alias("band")
        return table(spark, sf, name).groupBy(band).agg(F.count(F.lit(1)).alias(out))

    return full_outer_merge(
        banded("customer", "c_acctbal", "customers"), banded("supplier", "s_acctbal", "suppliers"), "band"
    )


def liquid_parts(spark: SparkSession, sf: str) -> DataFrame:
    """HAVING on aggregates with OR."""
    grouped = table(spark, sf, "lineitem").groupBy("l_partkey").agg(
        F.sum("l_quantity").alias("tot_cnt"), F.max("l_extendedprice").alias("top_price")
    )
    return grouped.where((F.col("tot_cnt") >= 900) | (F.col("top_price") >= 100_000))


# --- files and incremental jobs ------------------------------------------


def _day_rows(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyyMMdd").alias("file_version_date")
    )


def _daily_types(events: DataFrame) -> DataFrame:
    return events.groupBy("file_version_date", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum(try_bigint(F.col("user_id"))).alias("users_sum")
    )


def incremental_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries, each followed by a run, then a rerun of the newest date."""
    base = shared_folder(spark, "incremental")
    raw, stage, ledger = f"{base}/raw", f"{base}/stage", f"{base}/ledger"
    rows = _day_rows(spark, sf)
    early = F.col("file_version_date") < "20240115"
    job = PartitionedJob({"events": raw}, _daily_types, stage, ledger=ledger, sort_by=["event_type"])
    write_partitions(rows.where(early), raw)
    job.run(spark)
    write_partitions(rows.where(~early), raw)
    job.run(spark)
    job.run(spark, rerun=[latest_partition(spark, raw)])
    return read_partitioned(spark, stage)


def csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as daily CSV, read back as text with dense row ids."""
    base = shared_folder(spark, "csv")
    day = F.date_format("ts", "yyyy-MM-dd").alias("dt")
    events = table(spark, sf, "events").select("event_id", "event_type", "props", day)
    events.hint("rebalance", "dt").write.option("header", True).option("escape", '"').partitionBy("dt").csv(f"{base}/in")
    read = read_csv_strings(spark, f"{base}/in", null_as_empty=True, date_col=None)
    numbered = with_dense_row_id(read.withColumn("file", F.col("_metadata.file_name")))
    dated = numbered.withColumn("file_version_date", F.replace(F.col("dt").cast("string"), F.lit("-"), F.lit("")))
    write_partitions(dated, f"{base}/raw")
    files = (
        read_partitioned(spark, f"{base}/raw")
        .groupBy("file_version_date", "file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.max("rowid") + 1).alias("top"),
            F.countDistinct("rowid").alias("ids_in_file"),
            F.min("rowid").alias("first_id"),
            F.sum(try_bigint("event_id")).alias("ids"),
            F.max(F.length("props")).alias("longest_props"),
        )
    )
    return files.groupBy("file_version_date").agg(
        F.sum("n").alias("rows_read"),
        F.min("first_id").alias("first_id"),
        F.bool_and((F.col("top") == F.col("n")) & (F.col("ids_in_file") == F.col("n"))).alias("dense"),
        F.sum("ids").alias("ids"),
        F.max("longest_props").alias("longest_props"),
    )


def _deliver(rows: DataFrame, folder: str, kind: str, name: str = "feed") -> None:
    """Write one vendor file per date, named by it: ``value`` is its text, or all columns of a CSV.

    A file that is there already is replaced.
    """
    spark = rows.sparkSession
    draft = shared_folder(spark, "draft")
    writer = rows.repartition("file_version_date").write.partitionBy("file_version_date")
    if kind == "csv":
        writer.option("header", True).option("escape", '"').csv(draft)
    else:
        writer.text(draft)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(draft).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    for date in list_partitions(spark, draft):
        for file in fs.globStatus(path(f"{draft}/file_version_date={date}/part-*")):
            fs.delete(path(f"{folder}/{name}_{date}.{kind}"), False)
            fs.rename(file.getPath(), path(f"{folder}/{name}_{date}.{kind}"))


def _json_files(rows: DataFrame, item: Column, head: Column | None = None, envelope: str = "{}") -> DataFrame:
    """One JSON array per date, as vendors deliver it; ``head`` goes first."""
    before, after = envelope.split("{}")
    listed = rows.groupBy("file_version_date").agg(
        F.concat_ws(",", F.sort_array(F.collect_list(item))).alias("items"),
        *([F.min(head).alias("head")] if head is not None else []),
    )
    parts = [F.col("head"), F.lit(",")] if head is not None else []
    return listed.select(
        "file_version_date", F.concat(F.lit(f"{before}["), *parts, "items", F.lit(f"]{after}")).alias("value")
    )


def csv_layout_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Daily CSV files of two layouts, built in one run."""
    base = shared_folder(spark, "drift")
    rows = _day_rows(spark, sf)
    odd = F.col("file_version_date").cast("int") % 2 == 1
    _deliver(rows.where(odd).select("event_id", "event_type", "user_id", "file_version_date"), f"{base}/in", "csv")
    _deliver(rows.where(~odd).select("user_id", "event_id", "file_version_date"), f"{base}/in", "csv")
    ingest.build_raw(spark, f"{base}/in", f"{base}/raw")
    return read_partitioned(spark, f"{base}/raw").groupBy("file_version_date").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.sum(try_bigint("event_id")).alias("ids"),
        F.sum(try_bigint("user_id")).alias("users"),
        F.count("event_type").alias("typed"),
        F.countDistinct("rowid").alias("row_ids"),
    )


def csv_stage_renamed(spark: SparkSession, sf: str) -> DataFrame:
    """Daily CSV files to a stage of renamed text; what is absent is ''."""
    base = shared_folder(spark, "renamed")
    rows = _day_rows(spark, sf).select(
        F.col("event_id").alias("Event Id"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("Event Type"),
        "file_version_date",
    )
    _deliver(rows, f"{base}/in", "csv")
    names = {"Event Id": "event_id", "Event Type": "event_type"}
    ingest.stage_csv(spark, f"{base}/in", f"{base}/stage", names)
    return read_partitioned(spark, f"{base}/stage").select("event_id", "event_type", "file_version_date")


def json_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Daily JSON files to text in the declared schema, numbered per file, in two runs."""
    base = shared_folder(spark, "json")
    rows = _day_rows(spark, sf)
    item = F.to_json(F.struct(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("kind")))
    early = F.col("file_version_date") < "20240115"
    for delivery in (early, ~early):
        _deliver(_json_files(rows.where(delivery), item), f"{base}/in", "json")
        ingest.stage_json(spark, f"{base}/in", f"{base}/stage", ["id", "kind", "absent"])
    return read_partitioned(spark, f"{base}/stage").groupBy("file_version_date").agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.sum(try_bigint("id")).alias("ids"),
        F.max("autonum").alias("last_number"),
        F.countDistinct("autonum").alias("numbers"),
        F.max(F.length("absent")).alias("absent_length"),
    )


def earnings_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Reported and upcoming JSON files by month, staged in two runs; some months have one kind only."""
    base = shared_folder(spark, "earnings")
    early = F.col("file_version_date") < "19950101"
    for delivery in (early, ~early):
        for name, rows in zip(("reported", "upcoming"), roles.earnings(spark, sf), strict=True):
            chosen = rows.where(delivery)
            item = F.to_json(F.struct(*[c for c in rows.columns if c != "file_version_date"]))
            _deliver(_json_files(chosen, item, envelope='{"earningsDates":{}}'), f"{base}/{name}", "json")
        ingest.stage_earnings(spark, f"{base}/reported", f"{base}/upcoming", f"{base}/stage")
    return read_partitioned(spark, f"{base}/stage")


def rank_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Technical-rank files of each class, staged in two runs; two days in three have one class only.

    The files of the large class come first; the others of those days come late.
    """
    base = shared_folder(spark, "ranks")
    day = F.to_date("file_version_date", "yyyyMMdd")
    turn = (F.dayofmonth(day) % 4).cast("int")
    kind = (F.col("event_id") % 4).cast("int")
    rows = _day_rows(spark, sf).withColumn("kind", kind).where((kind == turn) | (F.dayofmonth(day) % 3 == 0))
    item = F.to_json(F.struct(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("event_id").cast("string").alias("vol"), F.col("event_type").alias("name"),
    ))
    # Files of the mid class name no date.
    head = F.when(F.col("kind") == 1, "{}").otherwise(F.to_json(F.struct(F.date_format(day, "yyyy-MM-dd").alias("date"))))
    paths = {name: f"{base}/{name}" for name in roles.CLASSES}
    for delivery in ([0], [1, 2, 3]):
        for i in delivery:
            _deliver(_json_files(rows.where(F.col("kind") == i), item, head), paths[roles.CLASSES[i]], "json")
        ingest.stage_technical_rank(spark, paths, f"{base}/stage")
    return read_partitioned(spark, f"{base}/stage")


def late_and_corrected_files(spark: SparkSession, sf: str) -> DataFrame:
    """Daily CSV files, then a second file of each day and corrected first ones of odd days."""
    base = shared_folder(spark, "late")
    rows = _day_rows(spark, sf)
    first, odd_day = F.col("event_id") % 2 == 0, F.substring("file_version_date", 8, 1).cast("int") % 2 == 1
    _deliver(rows.where(first & (F.col("user_id") % 3 == 0)), f"{base}/in", "csv")
    ingest.build_raw(spark, f"{base}/in", f"{base}/raw")
    _deliver(rows.where(~first), f"{base}/in", "csv", "late")
    _deliver(rows.where(first & odd_day), f"{base}/in", "csv")
    ingest.build_raw(spark, f"{base}/in", f"{base}/raw", follow_changes=True)
    # Nothing is new for a third run.
    again = ingest.build_raw(spark, f"{base}/in", f"{base}/raw", follow_changes=True)
    return read_partitioned(spark, f"{base}/raw").groupBy("file_version_date").agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(try_bigint("event_id")).alias("ids"),
        F.lit(len(again)).alias("taken_again"),
    )


def bars_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Price bars of a day inside one envelope, staged."""
    base = shared_folder(spark, "bars")
    rows = _day_rows(spark, sf)
    bar = F.to_json(F.struct(
        (F.col("event_id") * 60_000).alias("t"), *[(F.col("event_id") + i).cast("double").alias(f) for i, f in enumerate("ohlcv")]
    ))
    _deliver(_json_files(rows, bar, envelope='{"results":{}}'), f"{base}/in", "json")
    ingest.stage_bars(spark, f"{base}/in", f"{base}/stage")
    return read_partitioned(spark, f"{base}/stage").groupBy("file_version_date").agg(
        F.count(F.lit(1)).alias("bars"), F.sum("open").alias("open"), F.sum("volume").alias("volume")
    )


def rerun_to_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A rerun that finds no rows for the newest date removes what it had."""
    base = shared_folder(spark, "empty")
    write_partitions(_day_rows(spark, sf), f"{base}/raw")
    newest = latest_partition(spark, f"{base}/raw")
    PartitionedJob({"events": f"{base}/raw"}, _daily_types, f"{base}/stage").run(spark)
    gone = PartitionedJob(
        {"events": f"{base}/raw"}, lambda events: _daily_types(events).where("events < 0"), f"{base}/stage"
    )
    gone.run(spark, rerun=[newest])
    return read_partitioned(spark, f"{base}/stage")


def empty_date_once(spark: SparkSession, sf: str) -> DataFrame:
    """A date without result rows is processed once: dates taken by each of three runs."""
    base = shared_folder(spark, "once")
    write_partitions(_day_rows(spark, sf), f"{base}/raw")
    oldest = min(list_partitions(spark, f"{base}/raw"))
    job = PartitionedJob(
        {"events": f"{base}/raw"},
        lambda events: _daily_types(events).where(F.col("file_version_date") != oldest),
        f"{base}/stage",
    )
    taken = [(run, len(job.run(spark))) for run in (1, 2, 3)]
    runs = spark.createDataFrame(taken, "run int, dates int")
    days = read_partitioned(spark, f"{base}/stage").agg(F.countDistinct("file_version_date").alias("staged_dates"))
    return runs.crossJoin(days)


def stream_two_files_one_date(spark: SparkSession, sf: str) -> DataFrame:
    """Every date arrives in two deliveries, each drained by its own run of the stream."""
    base = shared_folder(spark, "twice")
    rows = _day_rows(spark, sf)
    half = F.col("event_id") % 2 == 0
    for delivery in (half, ~half):
        rows.where(delivery).hint("rebalance", "file_version_date").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        stream_partitions(stream, f"{base}/raw", f"{base}/checkpoint", with_row_id)
    return _daily_types(read_partitioned(spark, f"{base}/raw"))


def append_gzip(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced, then appended to, both gzip, each part with a literal source."""
    target = shared_folder(spark, "append")
    parts = table(spark, sf, "customer"), table(spark, sf, "supplier")
    for (prefix, frame), write in zip(zip("cs", parts, strict=True), (write_table, append_table), strict=True):
        names = frame.select(F.col(f"{prefix}_name").alias("name"), F.col(f"{prefix}_nationkey").alias("nation"))
        write(add_literal(names, source=prefix), target, "gzip")
    return spark.read.parquet(target)


def quarter_days(spark: SparkSession, sf: str) -> DataFrame:
    """Every day from the first to the last order, with its orders."""
    orders = table(spark, sf, "orders")
    days = days_spanned(orders, "o_orderdate")
    counts = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return days.join(counts, "day", "left").select("day", F.coalesce("orders", F.lit(0)).alias("orders"))


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """The raw ingest as an available-now stream: two deliveries, two runs."""
    base = shared_folder(spark, "stream")
    landing = f"{base}/in"
    rows = _day_rows(spark, sf)
    early = F.col("file_version_date") < "20240115"
    for delivery in (early, ~early):
        rows.where(delivery).hint("rebalance", "file_version_date").write.mode("append").parquet(landing)
        stream = spark.readStream.schema(rows.schema).parquet(landing)
        stream_partitions(stream, f"{base}/raw", f"{base}/checkpoint", with_row_id)
    return _daily_types(read_partitioned(spark, f"{base}/raw"))


def master_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The symbol master recomputed and written as a whole table."""
    target = shared_folder(spark, "master")
    names = ["screener", "fundamentals", "technical_rank", "option_screener"]
    refresh_table(dict(zip(names, roles.master_sources(spark, sf))), master.symbol_master, target)
    return spark.read.parquet(target)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        trade_cube,
        trade_cube_strict,
        trade_cube_staged,
        cube_distinct,
        cube_distinct_dense,
        chain_base,
        option_trades_by_chain,
        strike_details,
        chain_analytics,
        chain_zscores,
        chain_zscores_filtered,
        chain_zscores_bucketed,
        contract_pivot,
        screener_metrics,
        sweep_premium_rollup,
        option_screener,
        symbol_master,
        composite_score,
        customer_percentiles,
        customer_percentiles_present,
        golden_record,
        fundamentals_typed,
        fundamentals_from_csv,
        ratings_typed,
        ticker_universe,
        universe_screen,
        text_functions,
        analyst_scores,
        earnings_calendar,
        technical_rank,
        intraday_bars,
        session_volume,
        flow_prints_clean,
        flow_prints_after_close,
        flow_contract_stats,
        open_interest_history,
        flow_stats_incremental,
        open_interest_incremental,
        daily_ticker_summary,
        flow_stats,
        order_neighbours,
        return_shares,
        order_zscores,
        attribute_values_pivot,
        calendar_of_orders,
        calendar_lookup,
        customer_date_windows,
        newest_orders,
        newest_flag,
        pending_dates,
        part_sets,
        party_stack,
        full_outer_parties,
        liquid_parts,
        incremental_rerun,
        csv_ingest,
        stream_ingest,
        csv_layout_drift,
        csv_stage_renamed,
        json_stage,
        earnings_feed,
        rank_feed,
        late_and_corrected_files,
        bars_feed,
        rerun_to_empty,
        empty_date_once,
        stream_two_files_one_date,
        append_gzip,
        quarter_days,
        master_refresh,
    )
}

__all__ = ["QUERIES", "doubles"]
