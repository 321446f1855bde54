"""Declared schemas and rename maps."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Types a declaration may name; any other name means string.
DECLARED_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}

# Fields of the stock-screener JSON.
SCREENER_FIELDS = """
atr bollinger_risk bollinger_width c c_liq change_1y change_30d change_7d co_name cr d_ex_d d_pay_d d_pay_r da
date dc_12_in dc_3_in deathcross_3 debt_equity_ratio dividend_yield dy_tr earnings_date earnings_date_in
eps_growth f_db12 f_db3 f_dt12 f_dt3 f_dtb_12 f_dtb_3 gc_12_in gc_3_in goldencross_3 id industry insider_power
mkt_cap mv100 mv100_p_s mv100_p_s_d mv12 mv200 mv21 mv21_mv100_s mv21_mv100_s_d mv21_p_s mv21_p_s_d mv26 mv35
mv35_mv100_s mv35_p_s mv35_p_s_d mv50 mv7 mv7_mv35_s mv7_mv35_s_d mv7_p_s mv7_p_s_d net_profit_margin pb_ratio
percentage piotroski_score pivotdate_short price price_to_sales prices_compared return_on_assets
return_on_equity_employed revenue_growth_rate rsi14 rsi21 score score_3 score_3_signal sector signal_duration
stop_loss symbol tick tickerId trailing_pe trend_12 trend_3 trend_position trend_position_12 type volume
""".split()
# Fields of the trending-stocks JSON.
TRENDING_FIELDS = """
symbol logoUrl score date co_name urlToComment urlJsonChartMain priceFormatted priceRaw change24h volumeFormatted
volumeRaw marketCapFormatted marketCapRaw change7d changeMonth pos
""".split()
# Columns of the ratings CSV.
RATINGS_RENAMES = {
    "Date": "date",
    "Status": "status",
    "Outer": "rating_by",
    "Rating": "rating",
    "Price": "targets",
    "Ticker": "symbol",
}
# Columns of the fundamentals CSV.
FUNDAMENTAL_RENAMES = {
    "Change": "perf_day_perc",
    "Company": "name",
    "Country": "country",
    "Earnings": "earnings_date",
    "Employees": "employees",
    "Exchange": "exchange",
    "Index": "index_holding",
    "Industry": "industry",
    "Insider Own": "insiderown_perc",
    "Insider Trans": "insidertrans_perc",
    "Inst Own": "instown_perc",
    "Inst Trans": "insttrans_perc",
    "Market Cap": "marketcap",
    "Option/Short": "option_short",
    "Sector": "sector",
    "Short Float": "shortfloat_perc",
    "Short Interest": "shortinterest",
    "Short Ratio": "shortratio",
    "Shs Float": "shsfloat",
    "Shs Outstand": "shsoutstand",
    "Target Price": "targetprice",
    "Ticker": "symbol",
    "Beta": "beta",
    "Book/sh": "booksh",
    "Cash/sh": "cashsh",
    "Current Ratio": "currentratio",
    "Debt/Eq": "debteq",
    "Dividend Est.": "dividend_est",
    "Dividend Ex-Date": "ex_div_date",
    "Dividend TTM": "dividend_ttm",
    "EPS (ttm)": "eps_ttm",
    "EPS next 5Y": "eps_next5y_perc",
    "EPS next Q": "eps_nextq",
    "EPS next Y": "eps_nexty",
    "EPS next Y Percentage": "eps_nexty_perc",
    "EPS past 5Y": "eps_past5y_perc",
    "EPS Q/Q": "eps_qq_perc",
    "EPS Surprise": "eps_surprise_perc",
    "EPS this Y": "eps_thisy_perc",
    "EPS Y/Y TTM": "eps_yy_ttm_perc",
    "Forward P/E": "forwardpe",
    "Gross Margin": "grossmargin_perc",
    "Income": "income",
    "LT Debt/Eq": "lt_debt_eq_perc",
    "Oper. Margin": "opermargin_perc",
    "P/B": "pb",
    "P/C": "pc",
    "P/E": "pe",
    "P/FCF": "pfcf",
    "P/S": "ps",
    "Payout": "payout_perc",
    "PEG": "peg",
    "Profit Margin": "profitmargin_perc",
    "Quick Ratio": "quickratio",
    "Recom": "recom",
    "ROA": "roa_perc",
    "ROE": "roe_perc",
    "ROI": "roi_perc",
    "Sales": "sales",
    "Sales past 5Y": "sales_past5y_perc",
    "Sales Q/Q": "sales_qq_perc",
    "Sales Surprise": "sales_surprise_perc",
    "Sales Y/Y TTM": "sales_yy_ttm_perc",
    "52W High": "w52_high_perc",
    "52W Low": "w52_low_perc",
    "52W Range From": "w52_low_range",
    "52W Range To": "w52_high_range",
    "ATR (14)": "atr",
    "Avg Volume": "avgvolume",
    "Perf Half Y": "perf_halfy_perc",
    "Perf Month": "perf_month_perc",
    "Perf Quarter": "perf_quarter_perc",
    "Perf Week": "perf_week_perc",
    "Perf Year": "perf_year_perc",
    "Perf YTD": "perf_ytd_perc",
    "Prev Close": "prev_close",
    "Price": "price",
    "Rel Volume": "relvolume",
    "RSI (14)": "rsi",
    "SMA20": "sma20_perc",
    "SMA200": "sma200_perc",
    "SMA50": "sma50_perc",
    "Volatility M": "volatilitym_perc",
    "Volatility W": "volatilityw_perc",
    "Volume": "volume",
    "Category": "category",
    "Asset Type": "assettype",
    "Return% 1Y": "return_1y_perc",
    "Sponsor": "sponsor",
    "ETF Type": "etf_flag",
    "Return% 3Y": "return_3y_perc",
    "Total Holdings": "total_holdings",
    "Return% 5Y": "return_5y_perc",
    "AUM": "aum",
    "Flows% 1M": "flows_1m_perc",
    "Flows% 3M": "flows_3m_perc",
    "Flows% YTD": "flows_ytd_perc",
    "Expense": "expense_perc",
    "ESG Type": "esg_type",
    "Dividend Type": "div_type",
    "Sector/Theme": "sector_theme",
    "Average Maturity": "avg_maturity",
    "Return% 10Y": "return_10y",
    "NAV%": "nav_perc",
    "Index Weighting": "index_weighting",
    "Commodity Type": "commodity_type",
    "Return% SI": "return_si",
    "NAV/sh": "nav_per_share",
    "Active/Passive": "active_passive",
    "Quant Type": "quant_type",
    "Tags": "tags",
    "Structure Type": "structure_type",
    "Region": "region_etf",
    "Flows% 1Y": "flows_1y",
    "Growth/Value": "growth_value_etf",
    "Dev/Emerg": "dev_emerg_etf",
    "Flows% 3Y": "flows_3y",
    "Inverse/Leveraged": "inv_lev_flag",
    "Currency": "currency",
    "Flows% 5Y": "flows_5y",
    "Fund Family": "fund_family",
    "Bond Type": "bond_type",
}


# Columns of the relational base tables, as a DDL string each.
BASE_TABLES = {
    "daily_bars": (
        "stockdaily_skey bigint, symbol string, tradedate date, open decimal(10,2), high decimal(10,2), "
        "low decimal(10,2), close decimal(10,2), adjclose decimal(10,2), volume int"
    ),
    "flow_prints": (
        "flow_imp_dt string, exec_tm string, tick_symb string, opts_exp string, opts_strk string, opts_typ string, "
        "tick_spot string, trans_dtls string, trans_typ string, opts_prem string, opts_price string, opts_iv string, "
        "opts_color string, opts_vol decimal(18,2), days_to_exp decimal(18,2), er_date string, div_date string, "
        "tick_indstry string, etf_flg string, tick_name string, dtls_side string, alrt_flg string, "
        "opts_oi decimal(18,2), flow_skey decimal(18,0)"
    ),
    "dark_pool_prints": (
        "dp_imp_dt string, exec_dt string, exec_tm string, tick_symb string, dp_vol string, dp_price string, "
        "avg_30d_vol_perc string, notional string, dp_type string, sec_type string, industry string, sector string, "
        "avg_30d_vol string, sec_float string, earnings string, dp_cancel_flg string, dp_skey decimal(18,0)"
    ),
    "ratings": (
        "symbol string, ratingdate date, ratingtype string, ratingby string, ratingvalue string, pricetarget string, "
        "insertdate date"
    ),
    "attribute_values": "symbol string, columnname string, datavalue string, insertdate date",
    "attributes": (
        "attributeid decimal(18,0), attributename string, attributecategory string, attributealias string"
    ),
    "company_basics": (
        "ticker string, company string, sector string, industry string, country string, marketcap string, "
        "peratio string, price string, change string, volume string"
    ),
    "technical_signals": (
        "ticker string, beta string, atr string, sma20 string, sma50 string, sma200 string, ftwhigh string, "
        "ftwlow string, rsi string, price string, change string, fromopen string, gap string, volume string, "
        "screenername string"
    ),
    "performance_signals": (
        "ticker string, perfweek string, perfmonth string, perfquart string, perfhalf string, perfyear string, "
        "perfytd string, volatilityw string, volatilitym string, recom string, avgvolume string, relvolume string, "
        "price string, change string, volume string, screenername string"
    ),
    "exchange_symbols": (
        "symbolsid int, symbol string, exchange string, exchangesuffix string, exchangename string, name string, "
        "date date, type string, iexid string, region string, currency string, isenabled string, figi string, "
        "cik int, lei string"
    ),
    "exchanges": (
        "exchangesid int, mic string, name string, longName string, tapeId string, oatsId string, refId string, "
        "type string"
    ),
    "exchange_tags": "tagsid int, name string",
    "exchange_sectors": "sectorsid int, name string",
    "exchange_companies": (
        "symbolid int, symbol string, companyname string, employees string, exchange string, industry string, "
        "website string, description string, ceo string, securityname string, issuetype string, sector string, "
        "primarysiccode string, tags array<string>, address string, address2 string, state string, city string, "
        "zip string, country string, phone string"
    ),
}


def string_schema(fields: Iterable[str | Mapping[str, object]]) -> T.StructType:
    """Schema from names, or from ``{name, type, nullable}`` declarations."""
    out = T.StructType()
    for field in fields:
        if isinstance(field, str):
            out.add(field, T.StringType(), True)
        else:
            kind = DECLARED_TYPES.get(str(field.get("type", "string")).lower(), T.StringType())
            out.add(str(field["name"]), kind, bool(field.get("nullable", True)))
    return out


def base_table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(BASE_TABLES[name])


def read_rename_map(spark: SparkSession, path: str) -> dict[str, str]:
    """``current_column,new_column`` CSV to a dict; a byte-order mark is ignored.

    The file has one line per column, so it is read on the driver.
    """
    text = spark.read.text(path, wholetext=True).first()[0].lstrip("﻿")
    rows = csv.DictReader(io.StringIO(text))
    return {row["current_column"]: row["new_column"] for row in rows}
