"""Vendor-shaped frames derived from the supplied tables.

Each function returns a frame with the columns of one feed. All rows of the
table take part; the values the feed needs are computed from the row's own.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.plans.feeds import ANALYST_SCHEMA, RESEARCH_SCHEMA
from quotelake.plans.fundamentals import FUNDAMENTAL_KINDS
from quotelake.plans.master import FUNDAMENTAL_INDUSTRIES, TECHNICAL_INDUSTRIES, TECHNICAL_SECTORS
from quotelake.plans.summary import EXCLUDED_ATTRIBUTE, SUMMARY_ATTRIBUTES

CONDITIONS = (
    "mlet mlat mlct tlct tlft tlet tlat slan slai mesl slcn slft mfsl isoi mlft auto cncl reg late"
).split()
SCREENER_SECTORS = ["Financial Services", "-", "Energy", "Technology", "", "Utilities", "Healthcare"]
SCREENER_INDUSTRIES = ["Gambling, Resorts & Casinos", "-", "Banks", "Software", "Gas", "Drugs", "Steel", "Rail"]
OPTION_SECTORS = ["Financial Services", "Energy", "Technology", "Utilities", "Healthcare", "Industrials"]
AS_OF = "2001-12-31 12:00:00"
# An expiry day of the prints, after the last trading hour.
AFTER_CLOSE = "2002-01-04 17:00:00"
FLOW_SIDES = ["A", "AA", "_A", "B", "_B_", "BB", "", "nan", "M", "A_A"]
TRANSACTIONS = ["SWEEP", "BLOCK", "SPLIT", "ML SWEEP", "TRADE"]
INDUSTRIES = [*FUNDAMENTAL_INDUSTRIES, "Banks", "-", ""]
TECH_SECTORS = [*TECHNICAL_SECTORS, "Energy", "-"]
TECH_INDUSTRIES = [*TECHNICAL_INDUSTRIES, "Banks", ""]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int") + 1)


def half(number: Column, by: int) -> Column:
    """Whole quotient."""
    return F.floor(number / by)


def sql_list(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def sql_pick(values: list[str], index: str) -> str:
    return f"element_at({sql_list(values)}, CAST(({index}) % {len(values)} AS INT) + 1)"


def _contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a contract each: twenty per symbol (call/put, five
    strikes, two expiries)."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        "concat('S', l_suppkey) AS underlying_symbol",
        "if(l_partkey % 2 = 0, 'call', 'put') AS option_type",
        "(l_partkey div 2 % 5) * 5 + 50 AS strike",
        f"{sql_pick(['2002-03-15', '2002-03-22'], 'l_partkey div 10')} AS expiry",
        f"{sql_pick(['020315', '020322'], 'l_partkey div 10')} AS expiry_code",
        "l_partkey % 20 AS contract_no",
    )
    return rows.selectExpr(
        "*",
        "concat(underlying_symbol, expiry_code, if(option_type = 'call', 'C', 'P'), '000', strike * 1000) AS option_chain_id",
        "(l_suppkey * 131 + contract_no * 977) % 2500 AS interest",
    )


def option_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    greeks = {
        "implied_volatility": "l_discount + 0.2D",
        "delta": "l_tax * 5 - 0.2D",
        "gamma": "l_discount / 10",
        "vega": "l_tax",
        "theta": "-l_tax / 2",
        "rho": "l_discount * l_tax",
        "theo": "l_extendedprice / l_quantity * 0.0098D",
    }
    return _contracts(spark, sf_dir).selectExpr(
        "concat(year(l_shipdate), '0101') AS file_version_date",
        "underlying_symbol",
        "option_chain_id",
        "option_type",
        "strike",
        "expiry",
        "CASE WHEN l_returnflag = 'A' THEN 'ask' WHEN l_returnflag = 'R' THEN 'bid' WHEN l_linenumber = 7 THEN NULL "
        "WHEN l_linenumber = 6 THEN 'no_side' ELSE 'mid' END AS side",
        f"{sql_pick(CONDITIONS, 'l_orderkey')} AS upstream_condition_detail",
        "CAST(l_quantity AS BIGINT) AS size",
        "floor(l_extendedprice) AS premium",
        "floor(l_extendedprice / l_quantity) / 100D AS price",
        "interest AS open_interest",
        *[f"if(l_linenumber = 5, NULL, {value}) AS {name}" for name, value in greeks.items()],
    )


def oi_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per contract and year."""
    keys = ["underlying_symbol", "option_chain_id", "strike", "contract_no", "interest"]
    grouped = (
        _contracts(spark, sf_dir)
        .selectExpr(*keys, "l_linestatus", "l_quantity", "concat(year(l_shipdate), '0101') AS file_version_date")
        .groupBy("file_version_date", *keys)
        .agg(
            F.expr("CAST(sum(if(l_linestatus = 'O', l_quantity, 0D)) AS BIGINT)").alias("now"),
            F.expr("CAST(sum(if(l_linestatus = 'F', l_quantity, 0D)) AS BIGINT)").alias("then"),
        )
    )
    return grouped.selectExpr(
        "file_version_date",
        "option_chain_id AS option_symbol",
        "underlying_symbol",
        "CAST(strike AS STRING) AS strike",
        "CASE contract_no WHEN 3 THEN '12.7' WHEN 4 THEN '' ELSE CAST(contract_no AS STRING) END AS dte",
        "CAST(now AS STRING) AS curr_vol",
        "CAST(then AS STRING) AS prev_vol",
        "format_number(interest, 0) AS curr_oi",
        "format_number(interest + then - 60, 0) AS last_oi",
        "CAST(60 - then AS STRING) AS oi_diff_plain",
    )


def option_screener(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per symbol and year, measured from its trades."""
    sums = {}
    for kind in ("call", "put"):
        sums[f"{kind}_volume"] = f"if(option_type = '{kind}', size, 0)"
        sums[f"{kind}_premium"] = f"if(option_type = '{kind}', premium, 0)"
        sums[f"{kind}_open_interest"] = f"if(option_type = '{kind}', open_interest, 0)"
        for side in ("ask", "bid"):
            at = f"option_type = '{kind}' AND side <=> '{side}'"
            sums[f"{kind}_volume_{side}_side"] = f"if({at}, size, 0)"
            sums[f"{kind}_{side}_paid"] = f"if({at}, premium, 0)"
    trades = option_trades(spark, sf_dir).selectExpr("*", "CAST(substr(underlying_symbol, 2) AS BIGINT) AS supp")
    grouped = trades.groupBy("file_version_date", "underlying_symbol", "supp").agg(
        *[F.expr(f"sum({value})").alias(name) for name, value in sums.items()]
    )
    text = {
        "put_call_ratio": "if(supp % 3 = 0, 0D, put_volume / (call_volume + 1))",
        "total_open_interest": "call_open_interest + put_open_interest",
        "bullish_premium": "call_ask_paid + put_bid_paid",
        "bearish_premium": "call_bid_paid + put_ask_paid",
        "avg30_volume": "supp * 10.5D",
        "volatility": "0.2D + supp % 7 / 16D",
        "iv30d": "0.1D + supp % 5 / 8D",
        "iv30d_1m": "supp % 4 / 4D",
        "iv_rank": "supp % 100 / 8D",
    }
    for kind in ("call", "put"):
        for plain in ("volume", "volume_ask_side", "volume_bid_side", "premium", "open_interest"):
            text[f"{kind}_{plain}"] = f"{kind}_{plain}"
        text[f"net_{kind}_premium"] = f"{kind}_ask_paid - {kind}_bid_paid"
        text[f"prev_{kind}_oi"] = f"{kind}_open_interest - {kind}_open_interest % 100"
        for days, parts in ((3, 2), (7, 3), (30, 4)):
            text[f"avg_{days}_day_{kind}_volume"] = f"{kind}_volume / (1 + supp % {parts})"
        text[f"avg_30_day_{kind}_oi"] = f"{kind}_open_interest / (1 + supp % 3)"
    return grouped.selectExpr(
        "underlying_symbol AS ticker",
        "file_version_date",
        *[f"CAST({value} AS STRING) AS {name}" for name, value in text.items()],
        f"{sql_pick(OPTION_SECTORS, 'supp')} AS sector",
        "concat('SYMBOL NUMBER ', supp) AS full_name",
        "if(supp % 9 = 0, 'ETF', 'Common Stock') AS issue_type",
        "if(supp % 11 = 0, 't', 'f') AS is_index",
    )


def master_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Screener, fundamentals, technical rank and option screener rows."""

    def symbol(key: Column) -> Column:
        return F.concat(F.lit("S"), key.cast("string"))

    cust, nation = F.col("c_custkey"), F.col("c_nationkey")
    screener = table(spark, sf_dir, "customer").select(
        symbol(half(cust, 3)).alias("symbol"),
        F.when(nation == 3, "-").otherwise(F.col("c_name")).alias("co_name"),
        F.when(nation == 7, F.lit(None)).otherwise(pick(SCREENER_SECTORS, cust)).alias("sector"),
        pick(SCREENER_INDUSTRIES, nation).alias("industry"),
    )
    supp = F.col("s_suppkey")
    fundamentals = table(spark, sf_dir, "supplier").select(
        symbol(supp).alias("symbol"),
        F.col("s_name").alias("name"),
        pick(["Technology", "-", "Energy"], supp).alias("sector"),
        pick(INDUSTRIES, supp).alias("industry"),
    )
    part = F.col("p_partkey")
    technical = table(spark, sf_dir, "part").select(
        symbol(half(part, 2)).alias("symbol"),
        F.col("p_name").alias("name"),
        pick(TECH_SECTORS, part).alias("sector"),
        pick(TECH_INDUSTRIES, part).alias("industry"),
    )
    order = F.col("o_custkey")
    options = table(spark, sf_dir, "orders").select(
        symbol(order).alias("ticker"),
        F.concat(F.upper("o_orderpriority"), F.lit("  HOLDINGS "), F.col("o_orderstatus")).alias("full_name"),
        pick(OPTION_SECTORS, order).alias("sector"),
    )
    return screener, fundamentals, technical, options


def cents_of(balance: str) -> str:
    return f"CAST(floor(abs({balance}) * 100 + 0.5) AS BIGINT) AS cents"


# Whole cents of a customer's balance, and decimal texts of some multiples; the vendor texts are formatted from these.
CENTS = cents_of("c_acctbal")
NUMBERS = [f"CAST(CAST(cents * 0.0{k} AS DECIMAL(12,2)) AS STRING) AS number{k}" for k in range(1, 8)]
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def fundamental_text(kind: str, i: int) -> str:
    """SQL of the i-th column's vendor text, in functions that both engines have; now and then '-' or ''."""
    number, value = f"number{i % 7 + 1}", f"(cents + {i * 53})"
    if kind == "percent":
        text = f"concat(CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END, {number}, '%')"
    elif kind == "magnitude":
        text = f"concat({number}, CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'B' END)"
    elif kind == "volume":
        text = f"concat({number}, CASE c_nationkey % 3 WHEN 0 THEN 'K' WHEN 1 THEN 'M' ELSE 'B' END)"
    elif kind == "date":
        month = f"substr('{MONTHS}', CAST({value} % 12 AS INT) * 3 + 1, 3)"
        text = f"concat({month}, ' ', CAST({value} % 28 + 1 AS STRING), ', ', CAST(2020 + {value} % 6 AS STRING))"
    elif kind == "payout":
        text = f"concat({number}, ' (', CAST({value} % 9 AS STRING), '.25%)')"
    elif kind == "flag":
        text = f"CASE {value} % 3 WHEN 0 THEN 'EQ' WHEN 1 THEN '' ELSE 'F' END"
    elif kind == "option":
        text = f"CASE WHEN cents % 3 > 0 THEN 'Yes / Yes' ELSE 'No / Yes' END"
    elif kind == "words":
        return f"concat('column {i} of ', c_name, ' in ', c_mktsegment)"
    else:
        text = number
    return f"CASE (cents + {i}) % 20 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE {text} END"


def fundamental_source_kind(name: str, kind: str) -> str | None:
    """Which texts a source column takes; None when the column is derived."""
    if kind.startswith("yield:"):
        return None
    if kind == "text":
        return "payout" if name.startswith("dividend") else "option" if name == "option_short" else "words"
    return kind


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vendor text columns per customer, formatted from the balance, nation, name and segment."""
    columns = []
    for i, (name, kind) in enumerate(FUNDAMENTAL_KINDS.items()):
        source = fundamental_source_kind(name, kind)
        if source:
            columns.append(f"{fundamental_text(source, i)} AS {name}")
    return table(spark, sf_dir, "customer").selectExpr("*", CENTS).selectExpr("*", *NUMBERS).selectExpr(*columns)


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole document text stands in for the price-target change."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 400).cast("int"))
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("symbol"),
        F.col("source").alias("status"),
        F.col("lang").alias("rating_by"),
        F.when(F.col("doc_id") % 13 == 0, "soon").otherwise(F.date_format(day, "yyyy-MM-dd")).alias("date"),
        F.when(F.col("doc_id") % 11 == 0, "").otherwise(F.replace("text", F.lit(" "), F.lit("→"))).alias("targets"),
        F.lit("20250101").alias("file_version_date"),
    )


def analyst_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Consensus and research JSON per user, parsed as the feed's files are."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))

    def seen(kind: str) -> Column:
        return F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0)).cast("double")

    users = events.groupBy("user_id").agg(
        F.max("event_type").alias("consensus"),
        seen("purchase").alias("buy"),
        seen("view").alias("hold"),
        seen("error").alias("sell"),
        F.sum("k").cast("double").alias("k_sum"),
        F.max("k").cast("double").alias("k_max"),
    )
    ticker = F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker")
    opinion = F.struct(
        "consensus",
        F.struct("buy", "hold", "sell").alias("distribution"),
    ).alias("analystConsensus")
    has_score = F.col("user_id") % 4 != 0
    scored = F.struct(
        F.when(has_score, F.col("k_sum")).alias("tipRanksScore"),
        F.col("k_max").alias("priceTarget"),
        F.col("buy").alias("bloggerConsensus"),
        F.when(has_score, F.col("sell")).alias("rawInsiderScore"),
        (F.col("k_max") * 2).alias("highestPriceTarget"),
    ).alias("research")
    consensus = users.select(F.from_json(F.to_json(F.struct(ticker, opinion)), ANALYST_SCHEMA).alias("r")).select("r.*")
    research = users.select(F.from_json(F.to_json(F.struct(ticker, scored)), RESEARCH_SCHEMA).alias("r")).select("r.*")
    return consensus, research


def earnings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Per customer and month: open orders as upcoming earnings, all others as reported."""
    orders = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("Symbol"),
        F.date_format("o_orderdate", "yyyyMM01").alias("file_version_date"),
        (F.col("o_orderstatus") == "O").alias("open"),
        F.floor("o_totalprice").alias("sales"),
        F.to_date("o_orderdate").alias("day"),
        "o_orderkey",
    )
    sums = orders.groupBy("Symbol", "file_version_date", "open").agg(
        F.sum("sales").cast("bigint").cast("string").alias("sales"),
        F.max("day").alias("day"),
        F.max("o_orderkey").cast("string").alias("Unmapped"),
    )
    keys, day = ["Symbol", "file_version_date"], F.date_format("day", "yyyy-MM-dd").alias("EarningsDate")
    period = F.concat(F.year("day").cast("string"), F.lit("Q"), F.quarter("day").cast("string")).alias("FiscalPeriod")
    reported = sums.where(~F.col("open")).select(*keys, F.col("sales").alias("ActualSales"), day, period)
    upcoming = sums.where("open").select(
        *keys, day, F.lit("confirmed").alias("EarningsType"), F.col("sales").alias("EstimatedSales"), "Unmapped"
    )
    return reported, upcoming


# Capitalisation class by event_id modulo 4.
CLASSES = ["largecap", "midcap", "smallcap", "etf"]


def technical_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header-plus-rows JSON text, one per event; every seventh has no date."""
    day = F.date_format("ts", "yyyy-MM-dd")
    header = F.when(F.col("event_id") % 7 == 0, "{}").otherwise(F.concat(F.lit('{"date":"'), day, F.lit('"}')))
    value = F.get_json_object("props", "$.k")
    row = F.concat(
        F.lit('{"symbol":"U'), F.col("user_id").cast("string"), F.lit('","SCTR":"'), value, F.lit('","extra":1}')
    )
    second = F.concat(F.lit('{"symbol":"E'), F.col("event_id").cast("string"), F.lit('","vol":"1"}'))
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("file_version_date"),
        F.element_at(F.lit(CLASSES), (F.col("event_id") % 4 + 1).cast("int")).alias("class"),
        F.concat(F.lit("["), header, F.lit(","), row, F.lit(","), second, F.lit("]")).alias("value"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bar per event, spread over a year so both clock offsets occur."""
    shift = (F.col("event_id") % 365) * 86_400_000
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    value = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id",
        (half(micros, 1000) + shift).alias("t"),
        value.alias("o"),
        (value + 1).alias("h"),
        (value - 1).alias("l"),
        (value * 2).alias("c"),
        F.col("user_id").cast("double").alias("v"),
    )


def flow_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a print of the last 60 days before ``AS_OF``."""
    today = f"DATE '{AS_OF[:10]}'"
    first = date.fromisoformat(AS_OF[:10]) - timedelta(days=3)
    expiries = [(first + timedelta(days=7 * week)).strftime("%m/%d/%Y") for week in range(5)]
    rows = _contracts(spark, sf_dir).selectExpr(
        "*", f"date_sub({today}, datediff({today}, CAST(l_shipdate AS DATE)) % 60) AS day", "l_orderkey + l_linenumber AS number"
    )
    return rows.selectExpr(
        "date_format(day, 'MM/dd/yyyy') AS flow_imp_dt",
        "concat(l_orderkey, ':', l_linenumber) AS exec_tm",
        "underlying_symbol AS tick_symb",
        f"{sql_pick(expiries, 'contract_no')} AS opts_exp",
        "CAST(strike AS STRING) AS opts_strk",
        "upper(option_type) AS opts_typ",
        "CAST(strike + l_orderkey % 5 - 2 AS STRING) AS tick_spot",
        f"{sql_pick(TRANSACTIONS, 'l_linenumber')} AS trans_typ",
        "CAST(floor(l_extendedprice / l_quantity) / 100D AS STRING) AS opts_price",
        "CAST(CAST(l_discount AS DECIMAL(10,2)) AS STRING) AS opts_iv",
        "CAST(l_quantity AS DECIMAL(10,2)) AS opts_vol",
        "CAST(NULL AS STRING) AS er_date",
        "concat('Industry ', l_suppkey % 8) AS tick_indstry",
        "if(l_suppkey % 5 = 0, 'True', 'False') AS etf_flg",
        f"if(number % 23 = 0, NULL, {sql_pick(FLOW_SIDES, 'number')}) AS dtls_side",
        "CAST((l_suppkey * 131 + contract_no * 977 + dayofyear(day)) % 300 AS DECIMAL(10,2)) AS opts_oi",
    )


def attribute_text(name: str, i: int, balance: str) -> str:
    """SQL of the i-th attribute's text from a balance, in functions that both engines have."""
    number, value = f"number{i % 7 + 1}", f"(cents + {i * 29})"
    if name == "earnings":
        day = f"lpad(CAST({value} % 28 + 1 AS STRING), 2, '0')"
        return f"CASE WHEN {value} % 5 = 0 THEN '-' ELSE concat('Nov ', {day}, ' AMC') END"
    if name == "volatility":
        return f"concat({number}, '% ', number{(i + 1) % 7 + 1}, '%')"
    if name in ("price", "prevclose"):
        return number
    signed = f"concat(CASE WHEN {balance} < 0 THEN '-' ELSE '' END, {number}, '%')"
    return f"CASE WHEN {value} % 13 = 0 THEN '-' ELSE {signed} END"


def attribute_values(rows: DataFrame, key: str, prefix: str) -> DataFrame:
    """Attribute-value rows for each key, formatted from its balance: percent text, '-', and words."""
    balance, names = f"{key[0]}_acctbal", [*SUMMARY_ATTRIBUTES, EXCLUDED_ATTRIBUTE]
    pairs = [
        f"named_struct('columnname', 'Attr {name}', 'datavalue', {attribute_text(name, i, balance)})"
        for i, name in enumerate(names)
    ]
    return (
        rows.selectExpr("*", cents_of(balance))
        .selectExpr("*", *NUMBERS)
        .selectExpr(f"concat('{prefix}', {key}) AS symbol", "cents", f"posexplode(array({', '.join(pairs)})) AS (pos, a)")
        # Each row lacks one attribute, to show that nothing shifts.
        .where(F.col("pos") != F.col("cents") % len(names))
        .select("symbol", "a.columnname", "a.datavalue")
    )


def attributes(spark: SparkSession) -> DataFrame:
    """The attribute dictionary: one row per attribute."""
    names = [*SUMMARY_ATTRIBUTES, EXCLUDED_ATTRIBUTE]
    return spark.createDataFrame(
        [(i, f"Attr {n}", "summary", n) for i, n in enumerate(names)],
        "attributeid int, attributename string, attributecategory string, attributealias string",
    )


def companies(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    prefix, key, name, nation = {
        "customer": ("C", "c_custkey", "c_name", "c_nationkey"),
        "supplier": ("S", "s_suppkey", "s_name", "s_nationkey"),
    }[source]
    rows = table(spark, sf_dir, source).join(
        table(spark, sf_dir, "nation"), F.col(nation) == F.col("n_nationkey")
    )
    return rows.select(
        F.concat(F.lit(prefix), F.col(key).cast("string")).alias("ticker"),
        F.col(name).alias("company"),
        pick(OPTION_SECTORS, F.col(key)).alias("sector"),
        F.col("n_name").alias("industry"),
    )
