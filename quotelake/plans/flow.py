"""Option-flow statistics from individual prints."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotelake.functions import (
    calendar_text_date,
    days_between,
    first_replace,
    half_away,
    replace_all_text,
    round_stable,
    week_end,
)
from quotelake.operators import attach_group_stats, keep_matching, value_neighbours
from quotelake.plans.jobs import PartitionedJob
from quotelake.session import partitions_for, shared_folder, shuffle_partitions, shuffles_end_with_writes
from quotelake.sources.lake import PARTITION, drop_partitions, list_partitions, read_partitioned

# Look-back in days, contract size, sides and their letters.
LOOK_BACK_DAYS = 40
LAST_TRADING_HOUR = 16
SHARES_PER_CONTRACT = 100
SIDES = {"ask": "A", "bid": "B", "mid": "M"}
MONEY = "decimal(10,2)"
EARNINGS_SUFFIXES = [" BMO", " AMC"]

CONTRACT = ["tick_symb", "opts_exp", "opts_strk", "opts_typ"]
CONTRACT_DAY = ["flow_imp_dt", *CONTRACT]
DESCRIPTIVE = ["er_date", "etf_flg", "dtls_side", "bull_side", "tick_indstry", "opts_oi"]


def _as_of(as_of: datetime | Column) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(as_of)


def _dated(prints: DataFrame) -> DataFrame:
    return prints.withColumns(
        {"flow_date": calendar_text_date("flow_imp_dt"), "exp_date": calendar_text_date("opts_exp")}
    )


def recent(dated: DataFrame, as_of: datetime | Column, after_close: bool = False) -> DataFrame:
    """Rows of the look-back period whose contract has not expired, by ``flow_date`` and ``exp_date``.

    ``after_close`` also drops contracts expiring today once the last trading
    hour has passed.
    """
    as_of = _as_of(as_of)
    today = as_of.cast("date")
    keep = days_between(today, "flow_date").between(0, LOOK_BACK_DAYS) & (F.col("exp_date") >= today)
    if after_close:
        keep = keep & ~((F.col("exp_date") == today) & (F.hour(as_of) > LAST_TRADING_HOUR))
    return dated.where(keep)


def _multi_leg() -> Column:
    """Also where the kind of transaction is not known."""
    return F.coalesce(F.col("trans_typ").contains("ML"), F.lit(True))


def _typed() -> list[Column]:
    """The columns of a print, with side, direction and moneyness."""
    stripped = first_replace("dtls_side", "_", "")
    side = (
        F.when((F.col("dtls_side") == "") | (F.lower("dtls_side") == "nan"), "M")
        .when(stripped.isin("A", "AA"), "A")
        .when(stripped.isin("B", "BB"), "B")
        .otherwise(stripped)
    )
    call, put = F.col("opts_typ") == "CALL", F.col("opts_typ") == "PUT"
    at_ask, at_bid = stripped.contains("A"), stripped.contains("B")
    direction = (
        F.when((call & at_ask) | (put & at_bid), "Bullish").when((call & at_bid) | (put & at_ask), "Bearish")
    ).otherwise("Others")
    spot, strike = F.col("tick_spot").cast(MONEY), F.col("opts_strk").cast(MONEY)
    moneyness = (
        F.when((call & (spot >= strike)) | (put & (spot <= strike)), "ITM").when(
            (call & (spot < strike)) | (put & (spot > strike)), "OTM"
        )
    )
    plain = ["tick_symb", "exec_tm", "opts_exp", "opts_typ", "er_date", "etf_flg", "opts_oi", "opts_iv"]
    return [
        *map(F.col, plain),
        strike.alias("opts_strk"),
        F.col("flow_imp_dt"),
        F.col("tick_indstry"),
        F.col("opts_price").cast(MONEY).alias("opts_price"),
        F.col("opts_vol").cast(MONEY).alias("opts_vol"),
        F.col("trans_typ"),
        side.alias("dtls_side"),
        spot.alias("tick_spot"),
        direction.alias("bull_side"),
        moneyness.alias("moneyness"),
    ]


def flow_prints_clean(prints: DataFrame, as_of: datetime | Column, after_close: bool = False) -> DataFrame:
    """Recent single-leg prints, typed, with side, direction and moneyness."""
    return recent(_dated(prints), as_of, after_close).where(~_multi_leg()).select(*_typed()).distinct()


def _hundredths(amount: str) -> Column:
    """A two-digit decimal as a whole number, which sums fast and exactly."""
    return (F.col(amount) * 100).cast("bigint")


def _share(part: str, whole: str) -> Column:
    """Share rounded to 4 digits, exact halves up; 0 without a whole."""
    ratio = F.col(part).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))
    return F.coalesce(round_stable(ratio, 4), F.lit(0.0))


def _measures() -> list[Column]:
    """Volume, premium and implied volatility of distinct typed prints."""
    iv = F.col("opts_iv").cast(MONEY)
    # price x volume x 100, in hundredths.
    premium = _hundredths("opts_price") * _hundredths("opts_vol") * SHARES_PER_CONTRACT / 100
    return [
        F.sum(_hundredths("opts_vol")).alias("vol"),
        F.sum(premium.cast("bigint")).alias("prem"),
        F.sum((iv * 100).cast("bigint")).alias("iv_sum"),
        F.count(iv).alias("iv_n"),
    ]


def flow_leaves(prints: DataFrame) -> DataFrame:
    """The prints reduced to contract, day, side and moneyness; all reports follow from these rows.

    They hang on no date of asking and a day's rows come from that day's prints
    alone, so they can be kept per day. ``multi_leg`` rows count for open
    interest only, as does ``all_vol``, which takes in repeated prints. Prints
    are placed by the leaf they belong to, once: repeated ones collapse there,
    and the leaves are then not shuffled. A leaf's prints are those of one
    contract, day and side, a bounded number.
    """
    typed = prints.select(_multi_leg().alias("multi_leg"), F.col("opts_vol").alias("__vol"), *_typed())
    keys = [*CONTRACT_DAY, *DESCRIPTIVE, "moneyness", "multi_leg"]
    # Not by columns that may be the same in all prints: Spark takes such out of a grouping and would shuffle again.
    placed = _dated(typed.repartition(*CONTRACT_DAY, "dtls_side", "moneyness"))
    once = placed.groupBy(*[c for c in placed.columns if c != "__vol"]).agg(F.sum("__vol").alias("__vol"))
    leaves = once.groupBy(*keys, "flow_date", "exp_date").agg(*_measures(), F.sum("__vol").alias("all_vol"))
    dates = ["flow_date", "exp_date"]
    return leaves.select(*CONTRACT_DAY, *dates, *[c for c in leaves.columns if c not in {*CONTRACT_DAY, *dates}])


def flow_contract_stats(clean: DataFrame) -> DataFrame:
    """Premium, volume and side shares per contract and day, and over all days, of clean prints."""
    return contract_stats(clean.groupBy(*CONTRACT_DAY, *DESCRIPTIVE, "moneyness").agg(*_measures()))


def contract_stats(leaves: DataFrame) -> DataFrame:
    """The same of leaves.

    Totals per symbol and day span many contracts and are aggregated.
    """
    return _contract_windows(_with_day_totals(leaves), CONTRACT, shuffle_partitions(leaves.sparkSession))


def _with_day_totals(leaves: DataFrame) -> DataFrame:
    kind = F.col("opts_typ")
    return attach_group_stats(
        leaves,
        ["tick_symb", "flow_imp_dt"],
        {
            "call_vol_i": F.sum(F.when(kind == "CALL", F.col("vol"))),
            "put_vol_i": F.sum(F.when(kind == "PUT", F.col("vol"))),
            "tot_vol_i": F.sum("vol"),
        },
    )


def _contract_windows(leaves: DataFrame, by: Sequence[str], partitions: int, keep: Sequence[str] = ()) -> DataFrame:
    """Sums and shares of leaves that have the day's totals; ``keep`` names columns that follow from contract and day.

    The prints are reduced to one row per contract, day, side and moneyness
    first. What is left of a contract is bounded by the look-back period, so
    the window sums over it are small even for a contract that holds a third of
    all prints. The windows go from the finest group to the contract, each a
    prefix of the one before, so one placement, by some columns of the contract,
    and one sort serve them all. That placement has a number of partitions of
    its own: the rows become several times wider here than the bytes that
    run-time coalescing goes by.
    """
    descriptive = DESCRIPTIVE
    leaves = leaves.repartition(partitions, *by)

    contract_day = [*CONTRACT, "flow_imp_dt"]
    by_side = [*contract_day, "dtls_side"]
    by_money = [*by_side, "moneyness"]
    measures = ("vol", "prem")

    def sums(rows: DataFrame, by: list[str], named: dict[str, Column]) -> DataFrame:
        group = Window.partitionBy(*by)
        return rows.withColumns({name: F.sum(value).over(group) for name, value in named.items()})

    def side_sums(scope: str) -> dict[str, Column]:
        return {
            f"{name}_{measure}_{scope}": F.when(F.col("dtls_side").contains(letter), F.col(measure))
            for measure in measures
            for name, letter in SIDES.items()
        }

    rows = sums(leaves, by_money, {f"opts_{m}_mny_imp_dt": F.col(m) for m in measures})
    rows = sums(rows, by_side, {f"opts_{m}_side_imp_dt": F.col(m) for m in measures} | {"__iv": F.col("iv_sum"), "__n": F.col("iv_n")})
    rows = sums(rows, contract_day, {f"opts_{m}_imp_dt": F.col(m) for m in measures} | side_sums("tsei"))
    rows = sums(rows, CONTRACT, {f"__{m}_tse": F.col(m) for m in measures} | side_sums("tse"))

    whole = {("tsei", m): f"opts_{m}_imp_dt" for m in measures} | {("tse", m): f"__{m}_tse" for m in measures}
    amounts = ["call_vol_i", "put_vol_i", "tot_vol_i"]
    amounts += [f"opts_{m}{g}_imp_dt" for g in ("", "_side", "_mny") for m in measures]
    parts = [(scope, m, f"{side}_{m}_{scope}") for scope, m in whole for side in SIDES]
    # Rows that differ in moneyness alone and agree in their sums are one row.
    sums_only = [*amounts, "__iv", "__n", "__vol_tse", "__prem_tse", *[name for _, _, name in parts]]
    return rows.select(*CONTRACT_DAY, *descriptive, *keep, *sums_only).distinct().select(
        *CONTRACT_DAY,
        *descriptive,
        *keep,
        *[(F.col(a) / 100.0).alias(a) for a in amounts],
        round_stable(F.col("__iv") / 100.0 / F.nullif(F.col("__n").cast("double"), F.lit(0.0)), 4).alias("opts_iv_imp_dt"),
        *[(F.coalesce(F.col(name), F.lit(0)) / 100.0).alias(name) for _, _, name in parts],
        *[_share(name, whole[scope, m]).alias(f"{name}_perc") for scope, m, name in parts],
    )


def open_interest_history(prints: DataFrame, as_of: datetime | Column, after_close: bool = False) -> DataFrame:
    """Open interest per contract and day with its neighbours and the latest.

    Ordered by the real date (the text order is wrong across a year end); rows
    are first reduced to one per contract, day and open interest.
    """
    rows = recent(_dated(prints), as_of, after_close)
    return _interest(rows.withColumns({"opts_strk": F.col("opts_strk").cast(MONEY), "all_vol": F.col("opts_vol")}))


def _interest(rows: DataFrame) -> DataFrame:
    """Open interest history of recent prints or leaves."""
    daily = rows.groupBy(*CONTRACT, "flow_imp_dt", "flow_date", "opts_oi").agg(F.sum("all_vol").alias("__vol"))
    rows = value_neighbours(
        daily.repartition(*CONTRACT), CONTRACT, ["flow_date", "opts_oi"], "opts_oi", "prev_oi", "nextday_oi", "last_oi"
    )
    change = F.col("opts_oi") - F.col("prev_oi")
    percent = change.cast("double") / F.nullif(F.col("opts_oi").cast("double"), F.lit(0.0)) * 100
    return rows.select(
        *CONTRACT_DAY,
        "opts_oi",
        "prev_oi",
        change.alias("delta_oi"),
        round_stable(percent, 2).alias("delta_oi_perc"),
        "nextday_oi",
        "last_oi",
        F.sum("__vol").over(Window.partitionBy(*CONTRACT_DAY)).alias("tot_vol"),
    )


def _percentage(text: str) -> Column:
    return F.col(text).cast("decimal(10,4)").cast("double") / 100


def _volatility(first: bool) -> Column:
    """One half of 'week month' text, '-' as 0, NULL without a space."""
    text = F.col("volatility")
    space = F.position(F.lit(" "), text)
    half = F.substr(text, F.lit(1), space - 1) if first else F.substr(text, space)
    number = F.trim(replace_all_text(half, "-", "0")).cast("decimal(10,4)").cast("double") / 100
    return F.when(space != 0, number)


# Output -> summary attribute, kept as text or read as a percentage.
SUMMARY_TEXT = {
    "tick_volume": "volume",
    "float_shares": "shsfloat",
    "rel_volume": "relvolume",
    "outstndg_shares": "shsoutstand",
    "price_last": "price",
    "rsi_14": "rsi",
    "atr_14": "atr",
    "beta_1year": "beta",
    "shortratio": "shortratio",
}
SUMMARY_PERCENT = {
    "price_chng_perc": "change",
    "price_chng_wkly": "perfweek",
    "price_chng_mthly": "perfmonth",
    "price_chng_ytd": "perfytd",
    "high_52week": "ftwhigh",
    "low_52week": "ftwlow",
    "sma50": "sma50",
    "sma200": "sma200",
    "shortfloat": "shortfloat",
    "insiderown": "insiderown",
}


def _summary_columns(summary: DataFrame, as_of: Column) -> DataFrame:
    earnings = F.col("earnings")
    for suffix in EARNINGS_SUFFIXES:
        earnings = replace_all_text(earnings, suffix)
    reported = F.try_to_date(F.concat(earnings, F.lit(" "), F.year(as_of).cast("string")), "MMM d yyyy")
    change = F.col("price").cast(MONEY).cast("double") - F.col("prevclose").cast(MONEY).cast("double")
    return summary.select(
        F.col("symbol").alias("tick_symb"),
        F.col("sector").alias("__sector"),
        F.col("companyname").alias("tick_name"),
        "industry",
        F.date_format(reported, "MM/dd/yyyy").alias("earnings_date"),
        F.when(F.col("price") != "-", round_stable(change, 2)).otherwise(F.lit(0.0)).alias("price_chng"),
        _volatility(True).alias("volatility_week"),
        _volatility(False).alias("volatility_month"),
        *[F.col(source).alias(out) for out, source in SUMMARY_TEXT.items()],
        *[_percentage(source).alias(out) for out, source in SUMMARY_PERCENT.items()],
    )


# Where the rows of the report lie: all strikes listed for one expiry, whose number is bounded.
EXPIRY = ["tick_symb", "opts_exp"]
# Leaves whose statistics, several times as wide, one task holds in about 150 MB.
LEAVES_PER_TASK = 200_000


def _with_interest(leaves: DataFrame, history: DataFrame) -> DataFrame:
    """The leaves with the open interest before, after and at last of their contract's day: ``oi`` lists what the history has."""
    known = F.collect_set(F.struct("prev_oi", "nextday_oi", "last_oi")).alias("oi")
    return leaves.join(history.groupBy(*CONTRACT_DAY).agg(known), CONTRACT_DAY, "left")


def _signals(stats: DataFrame) -> DataFrame:
    rows = stats.select(*[c for c in stats.columns if c != "oi"], F.inline_outer("oi"))
    total, calls, puts = F.col("tot_vol_i"), F.col("call_vol_i"), F.col("put_vol_i")
    call_share = (
        F.when(total == calls, F.lit(1.0))
        .when(calls == 0, F.lit(0.0))
        .otherwise(round_stable((total - puts).cast("double") / F.nullif(total.cast("double"), F.lit(0.0)), 4))
    )
    day = Window.partitionBy(*CONTRACT_DAY)
    unusual = F.max(F.when(F.col("opts_vol_imp_dt") > F.col("opts_oi"), "Yes").otherwise("No")).over(day)
    ties = ["dtls_side", "bull_side", "opts_oi", "prev_oi", "nextday_oi", "opts_vol_mny_imp_dt", "opts_prem_mny_imp_dt"]
    ties += ["er_date", "etf_flg", "tick_indstry"]
    largest_first = [F.col("opts_vol_side_imp_dt").desc(), *[F.col(c).asc_nulls_last() for c in ties]]
    reachable = F.col("opts_vol_imp_dt") + F.col("opts_oi").cast("double")
    closed = (F.col("nextday_oi") < reachable) & (F.row_number().over(day.orderBy(*largest_first)) == 1)
    rounded = {
        c: half_away(F.col(c))
        for c in stats.columns
        if c.endswith(("_tsei", "_tse"))
    }
    return rows.withColumns(
        {
            "call_vol_i_perc": call_share,
            "unusual_flg": unusual,
            "delta_chng_vol": F.when(closed, reachable - F.col("nextday_oi").cast("double")).otherwise(F.lit(0.0)),
            **rounded,
        }
    ).drop("call_vol_i", "put_vol_i", "tot_vol_i")


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with shuffles_end_with_writes(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def flow_stats(
    prints: DataFrame,
    summary: DataFrame,
    as_of: datetime | Column,
    after_close: bool = False,
) -> DataFrame:
    """The flow report: contract statistics, open interest and ticker summary.

    Weeks to expiry count from the week of the day after ``as_of``. The ISO
    week end is date arithmetic, so no calendar table is joined.
    """
    # A print without symbol or expiry is dropped by the joins below.
    prints = prints.where(F.col("tick_symb").isNotNull() & F.col("opts_exp").isNotNull())
    leaves = flow_leaves(recent(_dated(prints), as_of, after_close))
    # Every branch below reads the leaves; the prints are read once.
    return flow_report(_kept(leaves, "flow_leaves"), summary, as_of, after_close)


def flow_report(
    leaves: DataFrame, summary: DataFrame, as_of: datetime | Column, after_close: bool = False
) -> DataFrame:
    """The flow report of stored leaves, of which only recent ones are looked at."""
    moment = _as_of(as_of)
    partitions = partitions_for(leaves, LEAVES_PER_TASK)
    leaves = recent(leaves.where(F.col("tick_symb").isNotNull() & F.col("opts_exp").isNotNull()), moment, after_close)
    about = _summary_columns(summary, moment).distinct()
    single_leg = leaves.where(~F.col("multi_leg"))
    expiries = keep_matching(single_leg.groupBy(*EXPIRY).agg(F.max("flow_date").alias("__newest")), about, ["tick_symb"])
    this_week = week_end(F.date_add(moment.cast("date"), 1))
    expiry_week = week_end(calendar_text_date("opts_exp"))
    listed = (
        expiries.drop("__newest")
        .withColumn("exp_wk_nbr", (F.floor(days_between(expiry_week, this_week) / 7) + 1).cast("int"))
        .withColumn("exp_wk_rownbr", F.dense_rank().over(Window.partitionBy("tick_symb").orderBy("exp_wk_nbr")))
    )
    newest = expiries.agg(F.max("__newest")).scalar()

    # The wide rows are made, reduced to what the report shows and joined where the narrow leaves were placed, by symbol
    # and expiry: what follows from a contract's day comes to the leaves, what follows from a symbol to its expiries.
    # The leaves are written after each join, so that its shuffle files go before the next ones come.
    single_leg = _kept(_with_interest(single_leg, _interest(leaves)), "flow_interest")
    stats = _contract_windows(_kept(_with_day_totals(single_leg), "flow_totals"), EXPIRY, partitions, keep=["oi"])
    side = F.when(F.col("dtls_side") == "A", "Ask").when(F.col("dtls_side") == "B", "Bid").otherwise("Mid")
    shown = _signals(stats).drop("er_date", "tick_indstry").withColumn("dtls_side", side).distinct()
    rows = shown.join(listed.join(about, "tick_symb"), EXPIRY)
    flow_date = calendar_text_date("flow_imp_dt")
    bullish = F.col("bull_side") == "Bullish"
    return rows.select(
        F.when(F.col("etf_flg") == "True", "ETFs").otherwise(F.col("__sector")).alias("sector"),
        *[c for c in about.columns if c != "__sector"],
        *[c for c in shown.columns if c != "tick_symb"],
        F.upper(F.date_format(flow_date, "EEE")).alias("flow_day"),
        F.dayofweek(flow_date).alias("flow_day_nbr"),
        "exp_wk_nbr",
        "exp_wk_rownbr",
        F.when(bullish, F.col("opts_vol_side_imp_dt")).otherwise(F.lit(0.0)).alias("bull_side_i_vol"),
        F.when(bullish, F.col("opts_prem_side_imp_dt")).otherwise(F.lit(0.0)).alias("bull_side_i_prem"),
        F.when(flow_date == newest, "Y").otherwise("N").alias("ltstflowdt"),
    )


def refresh_leaves(spark: SparkSession, prints: str, store: str, rerun: Sequence[str] = ()) -> list[str]:
    """Leaves of the days of ``prints`` (one folder a day) that ``store`` does not have; no other day is read.

    Reports read a day's leaves whole, so these are not sorted: sampling the
    ranges of a sort would compute the leaves a second time.
    """
    days = PartitionedJob(
        {"prints": prints},
        lambda prints: flow_leaves(prints).withColumn(PARTITION, F.date_format("flow_date", "yyyyMMdd")),
        store,
    )
    return days.run_whole(spark, rerun)


def stored_leaves(spark: SparkSession, store: str, as_of: datetime, after_close: bool = False) -> DataFrame:
    """The recent leaves; only the folders of the look-back period are opened."""
    first, last = (as_of.date() - timedelta(days=back) for back in (LOOK_BACK_DAYS, 0))
    days = [d for d in list_partitions(spark, store) if f"{first:%Y%m%d}" <= d <= f"{last:%Y%m%d}"]
    return recent(read_partitioned(spark, store, values=days).drop(PARTITION), as_of, after_close)


def age_out(spark: SparkSession, store: str, as_of: datetime) -> list[str]:
    """Drop the days that no report from ``as_of`` on looks at; returns them."""
    first = as_of.date() - timedelta(days=LOOK_BACK_DAYS)
    old = [d for d in list_partitions(spark, store) if d < f"{first:%Y%m%d}"]
    drop_partitions(spark, store, old)
    return old


def stored_contract_stats(spark: SparkSession, store: str, as_of: datetime) -> DataFrame:
    """``flow_contract_stats`` from stored leaves."""
    return contract_stats(stored_leaves(spark, store, as_of).where(~F.col("multi_leg")))


def stored_open_interest(spark: SparkSession, store: str, as_of: datetime) -> DataFrame:
    """``open_interest_history`` from stored leaves."""
    return _interest(stored_leaves(spark, store, as_of))
