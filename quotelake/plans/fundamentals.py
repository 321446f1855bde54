"""Typed fundamentals and ratings, and the universe screens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import compact_date, first_replace, replace_all_text
from quotelake.operators import latest_snapshot

# Output columns in order, by kind of text.
#   text       kept as it is
#   flag       1 when two characters long
#   number     plain number
#   percent    '12.3%'
#   magnitude  '1.2B' or '340M', in millions
#   volume     '450K', '1.2M' or '1.2B', in millions
#   date       'Jan 5, 2025' to '20250105'
#   yield:x    the percentage inside 'v (p%)' of column x
FUNDAMENTAL_KINDS = {
    "symbol": "text",
    "name": "text",
    "sector": "text",
    "industry": "text",
    "country": "text",
    "exchange": "text",
    "index_holding": "text",
    "etf_flag": "flag",
    "pe": "number",
    "eps_ttm": "number",
    "insiderown_perc": "percent",
    "shsoutstand": "magnitude",
    "marketcap": "magnitude",
    "perf_week_perc": "percent",
    "forwardpe": "number",
    "eps_nexty": "number",
    "insidertrans_perc": "percent",
    "shsfloat": "magnitude",
    "perf_month_perc": "percent",
    "income": "magnitude",
    "peg": "number",
    "eps_nextq": "number",
    "instown_perc": "percent",
    "shortfloat_perc": "percent",
    "perf_quarter_perc": "percent",
    "sales": "magnitude",
    "ps": "number",
    "eps_thisy_perc": "percent",
    "insttrans_perc": "percent",
    "shortratio": "number",
    "perf_halfy_perc": "percent",
    "booksh": "number",
    "pb": "number",
    "eps_nexty_perc": "percent",
    "roa_perc": "percent",
    "shortinterest": "magnitude",
    "perf_year_perc": "percent",
    "cashsh": "number",
    "pc": "number",
    "eps_next5y_perc": "percent",
    "roe_perc": "percent",
    "w52_low_range": "number",
    "w52_high_range": "number",
    "perf_ytd_perc": "percent",
    "dividend_est": "text",
    "dividend_est_perc": "yield:dividend_est",
    "pfcf": "number",
    "eps_past5y_perc": "percent",
    "roi_perc": "percent",
    "w52_high_perc": "percent",
    "w52_low_perc": "percent",
    "beta": "number",
    "dividend_ttm": "text",
    "dividend_ttm_perc": "yield:dividend_ttm",
    "quickratio": "number",
    "sales_past5y_perc": "percent",
    "grossmargin_perc": "percent",
    "atr": "number",
    "ex_div_date": "date",
    "currentratio": "number",
    "eps_yy_ttm_perc": "percent",
    "opermargin_perc": "percent",
    "rsi": "number",
    "volatilityw_perc": "percent",
    "volatilitym_perc": "percent",
    "employees": "text",
    "debteq": "number",
    "sales_yy_ttm_perc": "percent",
    "profitmargin_perc": "percent",
    "recom": "number",
    "targetprice": "number",
    "option_short": "text",
    "lt_debt_eq_perc": "number",
    "eps_qq_perc": "percent",
    "payout_perc": "percent",
    "relvolume": "number",
    "prev_close": "number",
    "sales_surprise_perc": "percent",
    "eps_surprise_perc": "percent",
    "sales_qq_perc": "percent",
    "earnings_date": "text",
    "avgvolume": "volume",
    "price": "number",
    "sma20_perc": "percent",
    "sma50_perc": "percent",
    "sma200_perc": "percent",
    "volume": "text",
    "perf_day_perc": "percent",
}
MISSING_MARK = "-"
UNIVERSE_MIN_VOLUME = 0.3  # millions
UNIVERSE_MIN_PRICE = 2.0


def _absent(text: Column) -> Column:
    return (text == MISSING_MARK) | (text == "")


def _number(text: Column) -> Column:
    return F.when(~_absent(text) | text.isNull(), F.trim(text).cast("float"))


def _percent(text: Column) -> Column:
    return F.when(~_absent(text) | text.isNull(), F.trim(replace_all_text(text, "%")).cast("float"))


def _scaled(text: Column, with_thousands: bool) -> Column:
    """Millions from a number with a unit letter; up to two characters is absent.

    Single-precision throughout: Spark divides in double, so the result is
    cast back.
    """
    number = F.substr(text, F.lit(1), F.length(text) - 1).cast("float")
    thousand = F.lit(1000).cast("float")
    value = F.when(F.position(F.lit("M"), text) > 1, number).otherwise(number * thousand)
    if with_thousands:
        value = F.when(F.position(F.lit("K"), text) > 1, (number / thousand).cast("float")).otherwise(value)
    return F.when((F.length(text) > 2) | text.isNull(), value)


def _yield(text: Column) -> Column:
    opening = F.position(F.lit("("), text)
    inside = F.substr(text, opening + 1, F.position(F.lit("%"), text) - opening - 1)
    return F.when(~_absent(text) | text.isNull(), inside.cast("float"))


def _typed(name: str, kind: str) -> Column:
    text = F.col(name)
    if kind == "text":
        return text
    if kind == "flag":
        return F.when(F.length(text) == 2, 1).otherwise(0)
    if kind == "number":
        return _number(text)
    if kind == "percent":
        return _percent(text)
    if kind in ("magnitude", "volume"):
        return _scaled(text, kind == "volume")
    if kind == "date":
        return F.when(~_absent(text), compact_date(F.to_date(text, "MMM d, yyyy")))
    if kind.startswith("yield:"):
        return _yield(F.col(kind.split(":", 1)[1]))
    raise ValueError(f"unknown kind {kind}")


def clean_numbers(df: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Typed columns from vendor text, one rule per output column."""
    return df.select(*[_typed(name, kind).alias(name) for name, kind in kinds.items()])


def fundamentals_typed(df: DataFrame) -> DataFrame:
    """88 typed columns; text that is neither a number nor '-' fails the job."""
    return clean_numbers(df, FUNDAMENTAL_KINDS)


def ratings_typed(df: DataFrame) -> DataFrame:
    """Distinct ratings with a compact date and a readable price-target change."""
    return df.select(
        "symbol",
        "status",
        "rating_by",
        compact_date(F.col("date").try_cast("date")).alias("ratings_date"),
        first_replace("targets", "→", ". . .").alias("price_target"),
        F.when(F.length("targets") == 0, "N").otherwise("Y").alias("pt_flag"),
        "file_version_date",
    ).distinct()


def ticker_universe(screener: DataFrame, date_col: str = "file_version_date") -> DataFrame:
    """Distinct non-index, non-ETF tickers of the newest snapshot."""
    return listed_stocks(latest_snapshot(screener, date_col))


def listed_stocks(newest: DataFrame) -> DataFrame:
    """The same for a frame of one date, such as ``read_latest`` gives of a table."""
    return newest.where((F.col("is_index") == "f") & (F.col("issue_type") != "ETF")).select("ticker").distinct()


def universe_screen(typed: DataFrame) -> DataFrame:
    """Optionable, actively traded and not a penny stock."""
    optionable = F.col("option_short").startswith("Yes")
    liquid = F.col("avgvolume") > UNIVERSE_MIN_VOLUME
    return typed.where(optionable & liquid & (F.col("price") > UNIVERSE_MIN_PRICE))
