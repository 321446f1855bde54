"""Products made straight from JSON feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.functions import eastern_offset_text, eastern_time, epoch_millis_utc
from quotelake.operators import conform, full_outer_merge, stack_frames

DAY = "file_version_date"

# The feeds' field names.
RESEARCH_SCORES = {
    "tipRanksScore": "tipRanksScore",
    "analystConsensus": "analyst_consensus_rating",
    "bloggerConsensus": "blogger_consensus_rating",
    "insiderSignal": "tr_insider_rating",
    "hedgeFundSignal": "tr_hedge_fund_rating",
    "newsSentiment": "tr_news_rating",
    "investorSentiment": "tr_investor_rating",
    "rawInsiderScore": "tr_insider_score",
    "rawHedgeFundsScore": "tr_hedge_fund_score",
    "rawNewsSentiment": "tr_news_score",
    "rawInvestorScore": "tr_investor_score",
}
RESEARCH_TARGETS = {
    "priceTarget": "tr_avg_price_target",
    "highestPriceTarget": "tr_high_pricetarget",
    "lowestPriceTarget": "tr_low_pricetarget",
}
ANALYST_SCHEMA = T.StructType().add("ticker", "string").add(
    "analystConsensus",
    T.StructType()
    .add("consensus", "string")
    .add("distribution", T.StructType().add("buy", "double").add("hold", "double").add("sell", "double")),
)
RESEARCH_SCHEMA = T.StructType().add("ticker", "string").add(
    "research", T.StructType([T.StructField(f, T.DoubleType()) for f in [*RESEARCH_SCORES, *RESEARCH_TARGETS]])
)

REPORTED_EARNINGS = [
    "Symbol",
    "ActualNetIncome",
    "ActualEPS",
    "EstimatedNetIncome",
    "FiscalPeriod",
    "EstimatedEPS",
    "EarningsDate",
    "EstimatedSales",
    "ActualSales",
]
UPCOMING_EARNINGS = {
    "EarningsDate": "Upcoming_EarningsDate",
    "EarningsType": "Upcoming_EarningsType",
    "EstimatedSales": "Upcoming_EstimatedSales",
    "EstimatedNetIncome": "Upcoming_EstimatedNetIncome",
    "EstimatedEPS": "Upcoming_EstimatedEPS",
    "Symbol": "Symbol",
}

TECHNICAL_COLUMNS = [
    "date",
    "symbol",
    "marketCap",
    "vol",
    "name",
    "SCTR",
    "delta",
    "industry",
    "sector",
    "close",
    "marketcaptype",
    "file_version_date",
]
CAP_CLASSES = {"largecap": "large", "midcap": "mid", "smallcap": "small", "etf": "etf"}

BARS_SCHEMA = T.StructType().add(
    "results",
    T.ArrayType(
        T.StructType([T.StructField("t", T.LongType())] + [T.StructField(f, T.DoubleType()) for f in "ohlcv"])
    ),
)
BAR_FIELDS = {"open": "o", "high": "h", "low": "l", "close": "c", "volume": "v"}
SESSION_OPEN = (9, 30)
SESSION_CLOSE = (16, 0)


def analyst_scores(consensus: DataFrame, research: DataFrame) -> DataFrame:
    """Consensus counts and research scores per ticker; an absent score is 0."""
    day = ["file_version_date"] if "file_version_date" in consensus.columns else []
    joined = consensus.join(research, ["ticker", *day])
    rated = F.col("analystConsensus.distribution")
    scores = {field: F.col(f"research.{field}") for field in [*RESEARCH_SCORES, *RESEARCH_TARGETS]}
    return joined.select(
        "ticker",
        *day,
        F.col("analystConsensus.consensus").alias("analyst_consensus"),
        *[rated[side].alias(f"{side}_count") for side in ("buy", "hold", "sell")],
        *[F.coalesce(scores[f], F.lit(0.0)).alias(out) for f, out in RESEARCH_SCORES.items()],
        *[scores[f].alias(out) for f, out in RESEARCH_TARGETS.items()],
    ).distinct()


def earnings_calendar(reported: DataFrame, upcoming: DataFrame, key: str = "Symbol") -> DataFrame:
    """Reported earnings full-joined with upcoming ones by symbol and, where the sides have it, date.

    Either side may lack optional columns; the symbol is required.
    """
    for side in (reported, upcoming):
        if key not in side.columns:
            raise ValueError(f"earnings without {key}")
    day = [DAY] if DAY in reported.columns and DAY in upcoming.columns else []
    left = conform(reported, [*REPORTED_EARNINGS, *day])
    right = conform(
        conform(upcoming, [*UPCOMING_EARNINGS, *day], keep_available_only=True).withColumnsRenamed(UPCOMING_EARNINGS),
        [*UPCOMING_EARNINGS.values(), *day],
    )
    merged = full_outer_merge(left, right, [key, *day])
    return merged.select(*REPORTED_EARNINGS, *[c for c in UPCOMING_EARNINGS.values() if c != key], *day)


def technical_rank(frames: Mapping[str, DataFrame], columns: Sequence[str] = TECHNICAL_COLUMNS) -> DataFrame:
    """Stack the capitalisation classes, tag each row with its class.

    A class without a header date takes the date of the others on that day.
    """
    stacked = stack_frames([df.withColumn("class", F.lit(name)) for name, df in frames.items()])
    return rank_rows(stacked, stacked.select(DAY, "date"), columns)


def rank_rows(rows: DataFrame, headers: DataFrame, columns: Sequence[str] = TECHNICAL_COLUMNS) -> DataFrame:
    """Rows of all classes (column ``class``); ``headers`` has each file's day and header date."""
    labels = F.create_map(*[F.lit(x) for pair in CAP_CLASSES.items() for x in pair])
    # Header dates are dates: their minimum needs no sorting.
    first = headers.groupBy(DAY).agg(F.min(F.to_date("date", "yyyy-MM-dd")).alias("__header"))
    joined = rows.withColumn("marketcaptype", labels[F.col("class")]).join(first, DAY, "left")
    header = F.date_format("__header", "yyyy-MM-dd")
    return conform(joined.withColumn("date", F.coalesce("date", header)), columns)


def session_flag(local, opening=SESSION_OPEN, closing=SESSION_CLOSE):
    """'Y' from the opening minute through the closing minute, inclusive."""
    minute = F.hour(local) * 60 + F.minute(local)
    inside = minute.between(opening[0] * 60 + opening[1], closing[0] * 60 + closing[1])
    return F.when(inside, "Y").otherwise("N")


def intraday_bars(
    bars: DataFrame,
    keep: Sequence[str] = (),
    zone: str = "America/New_York",
    with_timestamp: bool = False,
) -> DataFrame:
    """Bars with the exchange-local time as text and a regular-session flag."""
    rows = bars.withColumn("__utc", epoch_millis_utc("t")).withColumn("__local", eastern_time("__utc", zone))
    return rows.select(
        *keep,
        eastern_offset_text("__utc", "__local").alias("date"),
        *[F.col(short).cast("double").alias(name) for name, short in BAR_FIELDS.items()],
        session_flag(F.col("__local")).alias("regular_trading"),
        *([F.col("__utc").alias("ts_utc")] if with_timestamp else []),
    )


def bars_from_envelope(envelope: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per element of ``results``."""
    return envelope.select(*keep, F.inline("results"))
