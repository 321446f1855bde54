import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from quotelake.plans import flow, fundamentals, master, screener, summary, trades
from quotelake.sources.schemas import base_table_schema
from tests.conftest import one, rows

TRADE_FIELDS = (
    "file_version_date underlying_symbol option_chain_id option_type strike expiry side upstream_condition_detail "
    "size premium price open_interest implied_volatility delta gamma vega theta rho theo"
).split()


def trade(chain="SPY250310C00565000", side="ask", code="slan", size="60", premium="100", **other):
    base = {
        "file_version_date": "20250307",
        "underlying_symbol": "SPY",
        "option_chain_id": chain,
        "option_type": "call" if "C0" in chain else "put",
        "strike": str(int(chain[-8:]) // 1000),
        "expiry": "2025-03-10",
        "side": side,
        "upstream_condition_detail": code,
        "size": size,
        "premium": premium,
        "price": "1.5",
        "open_interest": "10",
        "implied_volatility": "0.25",
        "delta": "",
    }
    return tuple({**dict.fromkeys(TRADE_FIELDS), **base, **other}[f] for f in TRADE_FIELDS)


def trade_frame(spark, *data):
    return spark.createDataFrame(list(data), ", ".join(f"{f} string" for f in TRADE_FIELDS))


def oi_frame(spark, *symbols, **other):
    fields = "file_version_date option_symbol underlying_symbol strike dte curr_vol prev_vol curr_oi last_oi oi_diff_plain"
    data = []
    for i, s in enumerate(symbols):
        row = ["20250307", s, "SPY", str(int(s[-8:]) // 1000), "3", str(100 + i), "50", "1,234", "1,200", "34"]
        data.append(tuple({**dict(zip(fields.split(), row)), **other}.values()))
    return spark.createDataFrame(data, ", ".join(f"{f} string" for f in fields.split()))


def test_cube_keeps_liquid_chains_only(spark):
    df = trade_frame(
        spark,
        trade(size="60"),
        trade(size="40", side="bid", code="mlet"),
        trade(chain="SPY250310P00565000", size="99", open_interest="99"),
        trade(chain="SPY250310P00560000", size="1", open_interest="100"),
    )
    got = rows(trades.option_trade_cube(df))
    assert {r["option_chain_id"][-8:] for r in got} == {"00565000", "00560000"}
    assert not [r for r in got if r["option_chain_id"] == "SPY250310P00565000"]
    totals = [r for r in got if r["side"] == "total" and r["option_tx_type"] is None]
    assert sorted((r["trade_count"], r["total_contracts"]) for r in totals) == [(1, 1), (2, 100)]
    assert {r["option_tx_type"] for r in got} == {None, "sweep", "auto_multileg"}
    assert all(r["wtd_avg_delta"] is None and r["wtd_avg_iv"] == 0.25 for r in got)


def test_bad_size_fails_bad_greek_does_not(spark):
    assert trades.option_trade_cube(trade_frame(spark, trade(size="100", delta="n/a"))).count() == 4
    with pytest.raises(Exception, match="not a number"):
        trades.option_trade_cube(trade_frame(spark, trade(size="many"))).collect()


def test_null_and_unknown_sides(spark):
    base = trades.chain_base(oi_frame(spark, "SPY250310C00565000"))
    df = trade_frame(
        spark,
        trade(size="1"),
        trade(size="2", side=None),
        trade(size="4", side="no_side"),
    )
    total = "total_strike_vol"
    lenient = trades.option_trades_by_chain(df, base)
    # A NULL or unknown side is counted again under 'total'.
    assert one(trades.strike_details(lenient))[total] == 7 + 2 + 4
    strict = trades.option_trades_by_chain(df, base, strict=True)
    assert one(trades.strike_details(strict))[total] == 7
    assert one(trades.chain_analytics(lenient, base))["total_vol"] == 7
    assert {r["side"] for r in rows(strict)} == {"total", "ask", "unknown", "no_side"}


def test_chain_base_decodes(spark):
    frame = oi_frame(spark, "SPY250310P00565000", "SPY250310P00565000", dte="12.7", curr_vol="200")
    got = one(trades.chain_base(frame))
    assert (got["expiry"], got["option_typ"], got["days_to_expiry"]) == (20250310, "P", 13)
    assert (got["curr_oi"], got["prev_oi"], got["chain_vol_diff"]) == (1234, 1200, 150)
    assert (got["unusual_curr_vol"], got["unusual_diff_vol"]) == (0.16, 0.12)
    zero = one(trades.chain_base(oi_frame(spark, "SPY250310P00565000", curr_oi="0")))
    assert zero["unusual_curr_vol"] is None
    assert trades.chain_base(frame, symbols=["QQQ"]).count() == 0
    assert trades.chain_base(frame, expiries=[20250310]).count() == 1


def test_chain_zscores(spark):
    chains = [f"SPY250310{k}00{s}000" for s in (560, 565, 570) for k in "CP"]
    base = trades.chain_base(oi_frame(spark, *chains))
    data = [trade(chain=c, size=str(10 * (i + 1)), premium=str(100 * (i + 1) ** 2)) for i, c in enumerate(chains)]
    got = rows(trades.chain_zscores(trades.chain_analytics(
        trades.option_trades_by_chain(trade_frame(spark, *data), base), base)), "option_chain_id")
    assert len(got) == 6
    strikes = {r["strike"]: r["total_strike_prem"] for r in got}
    assert strikes == {560.0: 500, 565.0: 2500, 570.0: 6100}
    # Each strike counts once although a call and a put carry it.
    mean, dev = statistics.mean(strikes.values()), statistics.stdev(strikes.values())
    for r in got:
        assert r["total_strike_prem_zscore"] == pytest.approx(round((r["total_strike_prem"] - mean) / dev, 2))
    for kind in ("call", "put"):
        volumes = [r["chain_vol_diff"] for r in got if r["option_type"] == kind]
        mean, dev = statistics.mean(volumes), statistics.stdev(volumes)
        for r in got:
            if r["option_type"] == kind:
                assert r["chain_vol_diff_zscore"] == pytest.approx(round((r["chain_vol_diff"] - mean) / dev, 2))
                assert r["chain_oi_diff_zscore"] is None  # no deviation


def test_trades_outside_the_chains_are_dropped(spark):
    base = trades.chain_base(oi_frame(spark, "SPY250310C00565000"))
    df = trade_frame(spark, trade(), trade(chain="SPY250310C00570000"))
    assert {r["option_chain_id"] for r in rows(trades.option_trades_by_chain(df, base))} == {"SPY250310C00565000"}


def test_symbol_master(spark):
    first = spark.createDataFrame(
        [
            ("A", "Alpha", "Financial Services", "Banks"),
            ("B", "-", "-", "Banks"),
            ("C", "Gamma", "-", "-"),
            ("D", None, None, None),
        ],
        "symbol string, co_name string, sector string, industry string",
    )
    second = spark.createDataFrame(
        [("B", "Beta", "Other", "Auto Parts"), ("E", "Epsilon", "", "Thermal Coal")],
        "symbol string, name string, sector string, industry string",
    )
    third = spark.createDataFrame(
        [("F", "Phi", "Health Care", "Paper"), ("E", "Later", "x", "y")],
        "symbol string, name string, sector string, industry string",
    )
    fourth = spark.createDataFrame(
        [("D", "DELTA CO", "Energy"), ("G", "GO", None)], "ticker string, full_name string, sector string"
    )
    got = {r["symbol"]: (r["name"], r["sector"], r["industry"]) for r in rows(master.symbol_master(first, second, third, fourth))}
    assert got == {
        "A": ("Alpha", "Financial", "Banks"),
        "B": ("Beta", "Financial", "Banks"),  # blank sector from the industry, name from the next source
        "C": ("Gamma", None, None),
        "D": ("Delta Co", None, None),
        "E": ("Epsilon", None, "Coal"),
        "F": ("Phi", "Healthcare", "Paper, Lumber & Forest Products"),
        "G": (None, None, None),
    }


def test_fundamentals_typed(spark):
    text = {name: "" for name, kind in fundamentals.FUNDAMENTAL_KINDS.items() if not kind.startswith("yield:")}
    text |= {
        "etf_flag": "EQ", "pe": " 12.5 ", "eps_ttm": "-", "insiderown_perc": "-1.5%", "marketcap": "1.1B",
        "shsfloat": "340.5M", "income": "-", "avgvolume": "450K", "dividend_est": "1.20 (3.45%)",
        "ex_div_date": "Jan 5, 2025", "option_short": "Yes / Yes", "price": "2.50", "employees": "007",
    }
    df = spark.createDataFrame([tuple(text.values())], ", ".join(f"{n} string" for n in text))
    typed = fundamentals.fundamentals_typed(df)
    assert len(typed.columns) == 88
    got = one(typed)
    assert got["etf_flag"] == 1 and got["pe"] == 12.5 and got["eps_ttm"] is None and got["insiderown_perc"] == -1.5
    assert got["marketcap"] == 1100.0 and got["shsfloat"] == 340.5 and got["income"] is None
    assert got["avgvolume"] == pytest.approx(0.45) and got["dividend_est_perc"] == pytest.approx(3.45)
    assert got["ex_div_date"] == "20250105" and got["employees"] == "007" and got["sales"] is None
    assert fundamentals.universe_screen(typed).count() == 1
    assert fundamentals.universe_screen(typed.withColumn("price", F.lit(1.0))).count() == 0
    with pytest.raises(Exception, match="(?i)cast"):
        fundamentals.fundamentals_typed(df.withColumn("pe", F.lit("odd"))).collect()


def test_ratings_typed(spark):
    data = [("A", "Upgrade", "X", "2025-01-31", "$5→$6→$7", "d")] * 2 + [("B", "Init", "Y", "soon", "", "d")]
    df = spark.createDataFrame(
        data, "symbol string, status string, rating_by string, date string, targets string, file_version_date string"
    )
    got = rows(fundamentals.ratings_typed(df), "symbol")
    assert len(got) == 2
    assert (got[0]["ratings_date"], got[0]["price_target"], got[0]["pt_flag"]) == ("20250131", "$5. . .$6→$7", "Y")
    assert (got[1]["ratings_date"], got[1]["pt_flag"]) == (None, "N")


def test_ticker_universe(spark):
    data = [("A", "f", "Common Stock", "1"), ("B", "t", "Index", "2"), ("C", "f", "ETF", "2"), ("D", "f", "ADR", "2")]
    df = spark.createDataFrame(data, "ticker string, is_index string, issue_type string, file_version_date string")
    assert [r["ticker"] for r in rows(fundamentals.ticker_universe(df))] == ["D"]


def test_screener_ratios(spark):
    fields = [*screener.WHOLE_COLUMNS, *screener.FRACTION_COLUMNS]
    text = {f: "10" for f in fields} | {
        "ticker": "A", "file_version_date": "d", "put_call_ratio": "0", "put_volume": "30", "call_volume": "12.7",
        "avg_3_day_call_volume": "0", "prev_call_oi": "junk", "volatility": "0.00005",
    }
    got = one(screener.screener_metrics(spark.createDataFrame([tuple(text.values())], ", ".join(f"{c} string" for c in text))))
    assert got["call_volume"] == 13 and got["put_call_ratio"] == round(30 / 13, 4)
    assert got["call_volume_spike_3d"] is None and got["call_oi_delta_perc"] is None
    assert got["put_volume_spike_30d"] == 3.0 and got["options_tot_volume"] == 43


def test_composite_score_terms(spark):
    metrics = {f"{k}_{m}": 0.0 for k in ("call", "put") for m in (
        "volume_spike_30d", "ask_perc", "oi_delta_perc", "oi_spike_30d", "sweep_volume", "volume", "sweep_ask_perc",
        "sweep_tot_perc", "sweep_premium", "premium", "ask_sweep_premium", "bid_sweep_premium", "sweep_premium_perc")}
    metrics |= {"net_call_premium": 0.0, "net_put_premium": 0.0, "avg_30_day_call_volume": 1.0,
                "avg_30_day_put_volume": 1.0, "bullish_premium": 1.0, "bearish_premium": 1.0}
    calm = {**metrics, "call_volume_spike_30d": 1.0, "put_volume_spike_30d": 1.0}
    hot = {**calm, "call_volume_spike_30d": 2.5, "net_call_premium": 5.0, "bullish_premium": 9.0}
    data = [("A", "d", *calm.values()), ("B", "d", *hot.values()), ("C", "d", *calm.values())]
    df = spark.createDataFrame(data, "ticker string, file_version_date string, " + ", ".join(f"{m} double" for m in calm))
    sectors = spark.createDataFrame([(t, "x") for t in "ABC"], "symbol string, sector string")
    got = {r["ticker"]: r["options_composite_score"] for r in rows(screener.composite_score(df, sectors))}
    # Three flags and the top volume-spike percentile (1.0) for B.
    assert got == {"A": 0.0, "B": 2.5, "C": 0.0}


def prints(spark, *changes):
    base = {
        "flow_imp_dt": "12/30/2024", "exec_tm": "1", "tick_symb": "A", "opts_exp": "01/17/2025", "opts_strk": "100",
        "opts_typ": "CALL", "tick_spot": "100", "trans_typ": "SWEEP", "opts_price": "1.25", "opts_iv": "0.5",
        "opts_vol": 10, "dtls_side": "_A_", "opts_oi": 100, "etf_flg": "False", "tick_indstry": "i",
    }
    schema = base_table_schema("flow_prints")
    from decimal import Decimal

    data = []
    for i, change in enumerate(changes):
        row = {**base, "exec_tm": str(i), **change}
        for c in ("opts_vol", "opts_oi"):
            row[c] = Decimal(row[c]) if row[c] is not None else None
        data.append(tuple(row.get(f.name) for f in schema))
    return spark.createDataFrame(data, schema)


AS_OF = dt.datetime(2025, 1, 3, 17, 0)


def test_flow_prints_clean(spark):
    frame = prints(
        spark,
        {},
        {"dtls_side": "BB"},
        {"dtls_side": ""},
        {"dtls_side": "NaN", "opts_typ": "PUT", "tick_spot": "101"},
        {"dtls_side": None},
        {"trans_typ": "ML SWEEP"},
        {"flow_imp_dt": "11/01/2024"},
        {"opts_exp": "01/02/2025"},
        {"opts_exp": "01/03/2025", "dtls_side": "A"},
    )
    got = {r["exec_tm"]: r for r in rows(flow.flow_prints_clean(frame, AS_OF))}
    assert set(got) == {"0", "1", "2", "3", "4", "8"}
    # Only the first underscore goes, so '_A_' is not a plain 'A' but still at the ask.
    assert (got["0"]["dtls_side"], got["0"]["bull_side"], got["0"]["moneyness"]) == ("A_", "Bullish", "ITM")
    assert (got["1"]["dtls_side"], got["1"]["bull_side"]) == ("B", "Bearish")
    assert got["2"]["dtls_side"] == "M" and got["3"]["dtls_side"] == "M" and got["4"]["dtls_side"] is None
    assert got["3"]["moneyness"] == "OTM"
    closed = flow.flow_prints_clean(frame, AS_OF, after_close=True)
    assert "8" not in {r["exec_tm"] for r in rows(closed)}


def test_flow_contract_stats(spark):
    frame = prints(spark, {"dtls_side": "A"}, {"dtls_side": "B", "opts_vol": 30}, {"opts_typ": "PUT", "dtls_side": "A", "opts_vol": 60})
    got = rows(flow.flow_contract_stats(flow.flow_prints_clean(frame, AS_OF)), "opts_typ", "dtls_side")
    ask = got[0]
    assert (ask["opts_prem_imp_dt"], ask["opts_prem_side_imp_dt"]) == (5000.0, 1250.0)
    assert (ask["ask_vol_tsei_perc"], ask["bid_prem_tse_perc"], ask["mid_vol_tsei"]) == (0.25, 0.75, 0.0)
    assert (ask["call_vol_i"], ask["put_vol_i"], ask["tot_vol_i"]) == (40.0, 60.0, 100.0)
    assert ask["opts_iv_imp_dt"] == 0.5


def test_open_interest_across_the_year(spark):
    frame = prints(spark, {}, {"flow_imp_dt": "12/31/2024", "opts_oi": 120}, {"flow_imp_dt": "01/02/2025", "opts_oi": 90})
    got = {r["flow_imp_dt"]: r for r in rows(flow.open_interest_history(frame, AS_OF))}
    middle = got["12/31/2024"]
    assert (middle["prev_oi"], middle["nextday_oi"], middle["last_oi"], middle["delta_oi"]) == (100, 90, 90, 20)
    assert middle["delta_oi_perc"] == 16.67
    assert got["12/30/2024"]["prev_oi"] is None and got["01/02/2025"]["nextday_oi"] is None


def ticker_summary(spark):
    names = [*summary.SUMMARY_ATTRIBUTES, summary.EXCLUDED_ATTRIBUTE]
    known = {"price": "10.5", "prevclose": "10", "volatility": "1.5% -", "earnings": "Jan 30 AMC", "change": "5%", "rsi": "-"}
    values = spark.createDataFrame(
        [("A", f"L {n}", known[n]) for n in known] + [("B", "L pe", "7%"), ("A", "L epsnexty", "1")],
        "symbol string, columnname string, datavalue string",
    )
    attributes = spark.createDataFrame(
        [(i, f"L {n}", "c", n) for i, n in enumerate(names)],
        "attributeid int, attributename string, attributecategory string, attributealias string",
    )
    companies = spark.createDataFrame(
        [("A", "Alpha", "Energy", "Oil"), ("B", "Beta", "Tech", "Chips"), ("C", "None", "x", "y")],
        "ticker string, company string, sector string, industry string",
    )
    return summary.daily_ticker_summary(values, attributes, companies)


def test_daily_ticker_summary(spark):
    got = {r["symbol"]: r for r in rows(ticker_summary(spark))}
    assert set(got) == {"A", "B"} and len(got["A"]) == 74
    assert got["A"]["change"] == "5" and got["A"]["rsi"] is None and got["A"]["pe"] is None
    assert got["B"]["pe"] == "7" and got["B"]["atr"] is None


def test_flow_stats(spark):
    frame = prints(
        spark,
        {"dtls_side": "A"},
        {"flow_imp_dt": "01/02/2025", "dtls_side": "B", "opts_vol": 300, "opts_oi": 105},
        {"opts_exp": "01/10/2025", "dtls_side": "A", "etf_flg": "True"},
        {"tick_symb": "Z"},
    )
    got = rows(flow.flow_stats(frame, ticker_summary(spark), AS_OF), "opts_exp", "flow_imp_dt")
    assert [r["tick_symb"] for r in got] == ["A", "A", "A"]
    assert [(r["exp_wk_nbr"], r["exp_wk_rownbr"]) for r in got] == [(2, 1), (3, 2), (3, 2)]
    first, newest, older = got
    assert first["sector"] == "ETFs" and newest["sector"] == "Energy"
    assert newest["ltstflowdt"] == "Y" and older["ltstflowdt"] == "N"
    assert newest["unusual_flg"] == "Yes" and older["unusual_flg"] == "No"
    # 10 contracts on 100 open could make 110, the next day shows 105.
    assert older["delta_chng_vol"] == 5.0 and older["nextday_oi"] == 105
    assert (older["flow_day"], older["flow_day_nbr"], older["dtls_side"]) == ("MON", 2, "Ask")
    assert older["earnings_date"] == "01/30/2025" and older["price_chng"] == 0.5
    assert older["volatility_week"] == 0.015 and older["volatility_month"] == 0.0
    assert older["price_chng_perc"] == 0.05
