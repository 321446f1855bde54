"""Daily ticker summary from attribute-value rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions import replace_all_text
from quotelake.operators import attribute_pivot

# The attribute columns of the summary, and the one left out.
SUMMARY_ATTRIBUTES = (
    "atr avgvolume beta booksh cashsh change currentratio debteq dividend dividendperc earnings employees "
    "epsnext5y epsnextq epspast5y epsqq epsthisy epsttm forwardpe ftwhigh ftwlow ftwrange grossmargin income "
    "index insiderown insidertrans instown insttrans ltdebteq marketcap opermargin optionable payout pb pc pe "
    "peg perfhalf perfmonth perfquarter perfweek perfyear perfytd pfcf prevclose price profitmargin ps "
    "quickratio recom relvolume roa roe roi rsi sales salespast5y salesqq shortable shortfloat shortratio "
    "shsfloat shsoutstand sma20 sma200 sma50 targetprice volatility volume"
).split()
EXCLUDED_ATTRIBUTE = "epsnexty"


def daily_ticker_summary(
    values: DataFrame,
    attributes: DataFrame,
    companies: DataFrame,
    names: Sequence[str] = SUMMARY_ATTRIBUTES,
) -> DataFrame:
    """One row per company with its attributes as columns, cleaned as text.

    The dictionary has one row per attribute kept, so it is sent to the tasks:
    a join that starts as a sort-merge would first ship all values by their few
    attribute names. Attributes outside ``names`` are filtered before the shuffle.
    """
    cleaned = F.when((F.col("datavalue") != "-") | F.col("datavalue").isNull(), replace_all_text("datavalue", "%"))
    aliases = attributes.select(F.col("attributename").alias("columnname"), "attributealias").where(
        (F.col("attributealias") != EXCLUDED_ATTRIBUTE) & F.col("attributealias").isin(list(names))
    )
    long = values.join(F.broadcast(aliases), "columnname").select("symbol", "attributealias", cleaned.alias("datavalue"))
    wide = attribute_pivot(long, "symbol", "attributealias", "datavalue", names)
    basics = companies.select(
        F.col("ticker").cast("string").alias("symbol"),
        "sector",
        F.col("company").alias("companyname"),
        "industry",
    )
    return basics.join(wide, "symbol").select("sector", "companyname", "industry", "symbol", *names)
