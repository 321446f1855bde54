"""Golden-record symbol master."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.functions import blank_to_null, canonical, title_case
from quotelake.operators import first_record
from quotelake.operators.joins import attach

# Canonical sector and industry names, per source.
FINANCIAL = {"Financial Services": "Financial"}
SCREENER_INDUSTRIES = {"Gambling, Resorts & Casinos": "Gambling"}
FUNDAMENTAL_INDUSTRIES = {
    "Apparel Manufacturing": "Apparel - Manufacturers",
    "Apparel Retail": "Apparel - Retail",
    "Auto & Truck Dealerships": "Auto - Dealerships",
    "Auto Manufacturers": "Auto - Manufacturers",
    "Auto Parts": "Auto - Parts",
    "Home Improvement Retail": "Home Improvement",
    "Oil & Gas E&P": "Oil & Gas Exploration & Production",
    "Paper & Paper Products": "Paper, Lumber & Forest Products",
    "Thermal Coal": "Coal",
}
TECHNICAL_SECTORS = {
    "Consumer Discretionary": "Consumer Cyclical",
    "Consumer Staples": "Consumer Defensive",
    "Materials": "Basic Materials",
    "Financial Services": "Financial",
    "Industrial": "Industrials",
    "Health Care": "Healthcare",
}
TECHNICAL_INDUSTRIES = {
    "Aerospace": "Aerospace & Defense",
    "Apparel Retailers": "Apparel - Retail",
    "Auto Parts": "Auto - Parts",
    "Automobiles": "Auto - Manufacturers",
    "Exploration & Production": "Oil & Gas Exploration & Production",
    "Furnishings": "Furnishings, Fixtures & Appliances",
    "Home Improvement Retailers": "Home Improvement",
    "Integrated Oil & Gas": "Oil & Gas Integrated",
    "Oil Equipment & Services": "Oil & Gas Equipment & Services",
    "Paper": "Paper, Lumber & Forest Products",
    "Specialty Retailers": "Specialty Retail",
    "Waste & Disposal Services": "Waste Management",
}
LONGEST_BLANK_NAME = 2
LONGEST_BLANK_GROUP = 1

CANDIDATE = ["symbol", "name", "sector", "industry", "priority"]


def _name(column: str):
    return blank_to_null(column, LONGEST_BLANK_NAME)


def _group(column: str, mapping: dict[str, str]):
    return canonical(blank_to_null(column, LONGEST_BLANK_GROUP), mapping)


def from_screener(df: DataFrame) -> DataFrame:
    """Priority 1. A blank sector is taken from the other rows of its industry.

    The greatest sector per industry is one small row per industry, joined
    back, so an industry's rows never gather in a window.
    """
    sector = canonical("sector", FINANCIAL)
    rows = df.select("symbol", F.col("co_name").alias("name"), "sector", "industry").distinct()
    known = rows.groupBy("industry").agg(F.max(sector).alias("__industry_sector"))
    no_sector = F.length("sector") <= LONGEST_BLANK_GROUP
    no_industry = F.length("industry") <= LONGEST_BLANK_GROUP
    filled = (
        F.when(no_sector & no_industry, F.lit(None))
        .when(no_sector & (F.length("industry") > LONGEST_BLANK_GROUP), F.col("__industry_sector"))
        .otherwise(sector)
    )
    industry = F.when(no_industry, F.lit(None)).otherwise(canonical("industry", SCREENER_INDUSTRIES))
    return attach(rows, known, ["industry"], "left").select(
        "symbol",
        F.when(F.length("name") <= LONGEST_BLANK_NAME, F.lit(None)).otherwise(F.col("name")).alias("name"),
        filled.alias("sector"),
        industry.alias("industry"),
        F.lit(1).alias("priority"),
    )


def from_fundamentals(df: DataFrame) -> DataFrame:
    """Priority 2."""
    return df.select(
        "symbol",
        _name("name").alias("name"),
        _group("sector", {}).alias("sector"),
        _group("industry", FUNDAMENTAL_INDUSTRIES).alias("industry"),
        F.lit(2).alias("priority"),
    )


def from_technical_rank(df: DataFrame) -> DataFrame:
    """Priority 3."""
    return df.select(
        "symbol",
        _name("name").alias("name"),
        _group("sector", TECHNICAL_SECTORS).alias("sector"),
        _group("industry", TECHNICAL_INDUSTRIES).alias("industry"),
        F.lit(3).alias("priority"),
    )


def from_option_screener(df: DataFrame) -> DataFrame:
    """Priority 4: names arrive in capitals, there is no industry."""
    return df.select(
        F.col("ticker").alias("symbol"),
        F.when(F.length("full_name") > LONGEST_BLANK_NAME, title_case("full_name")).alias("name"),
        _group("sector", FINANCIAL).alias("sector"),
        F.lit(None).cast("string").alias("industry"),
        F.lit(4).alias("priority"),
    )


def symbol_master(
    screener: DataFrame,
    fundamentals: DataFrame,
    technical_rank: DataFrame,
    option_screener: DataFrame,
) -> DataFrame:
    """One row per symbol from the best source; a missing name falls back to
    the symbol's greatest name in any source."""
    candidates = (
        from_screener(screener)
        .unionByName(from_fundamentals(fundamentals))
        .unionByName(from_technical_rank(technical_rank))
        .unionByName(from_option_screener(option_screener))
    )
    best = first_record(candidates, "symbol", ["priority", "sector", "industry"], "name", "max_name")
    return best.select("symbol", F.coalesce("name", "max_name").alias("name"), "sector", "industry")
