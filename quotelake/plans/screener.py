"""Per-symbol option screener and the sector-relative composite score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import round_scaled, safe_ratio, try_bigint, try_double
from quotelake.operators import peer_percentile
from quotelake.plans.trades import transaction_type

DAY = "file_version_date"

# The feed's whole-number and fractional columns.
WHOLE_COLUMNS = [
    "call_volume",
    "call_volume_ask_side",
    "call_volume_bid_side",
    "call_open_interest",
    "prev_call_oi",
    "put_volume",
    "put_volume_ask_side",
    "put_volume_bid_side",
    "put_open_interest",
    "prev_put_oi",
    "total_open_interest",
    "bullish_premium",
    "bearish_premium",
    "call_premium",
    "net_call_premium",
    "put_premium",
    "net_put_premium",
]
FRACTION_COLUMNS = [
    "put_call_ratio",
    "avg_3_day_call_volume",
    "avg_3_day_put_volume",
    "avg_7_day_call_volume",
    "avg_7_day_put_volume",
    "avg_30_day_call_volume",
    "avg_30_day_put_volume",
    "avg_30_day_put_oi",
    "avg_30_day_call_oi",
    "avg30_volume",
    "volatility",
    "iv30d",
    "iv30d_1m",
    "iv_rank",
]
SPIKE_DAYS = (3, 7, 30)
KINDS = ("call", "put")


def screener_metrics(screener: DataFrame) -> DataFrame:
    """Typed screener row with its ratios; a zero denominator gives NULL."""
    c = F.col
    typed = screener.select(
        "ticker",
        DAY,
        *[try_bigint(name).alias(name) for name in WHOLE_COLUMNS],
        *[round_scaled(try_double(name), 4).alias(name) for name in FRACTION_COLUMNS],
    )
    both = c("call_volume") + c("put_volume")
    bullish = c("call_volume_ask_side") + c("put_volume_bid_side")
    bearish = c("call_volume_bid_side") + c("put_volume_ask_side")
    ratio = c("put_call_ratio")
    derived: dict[str, Column] = {
        "put_call_ratio": F.when(ratio == 0, safe_ratio("put_volume", "call_volume", 4)).otherwise(ratio),
        "options_tot_volume": both,
        "bullish_volume": bullish,
        "bullish_volume_perc": safe_ratio(bullish, both, 4),
        "bearish_volume": bearish,
        "bearish_volume_perc": safe_ratio(bearish, both, 4),
        "call_skew": safe_ratio(c("call_volume_ask_side") - c("call_volume_bid_side"), both, 4),
        "put_skew": safe_ratio(c("put_volume_bid_side") - c("put_volume_ask_side"), both, 4),
        "iv_spike_d": safe_ratio(c("volatility") - c("iv30d"), "volatility", 4),
        "iv_spike_30d": safe_ratio(c("volatility") - c("iv30d_1m"), "volatility", 4),
    }
    for kind in KINDS:
        volume, interest, before = f"{kind}_volume", f"{kind}_open_interest", f"prev_{kind}_oi"
        derived[f"{kind}_ask_perc"] = safe_ratio(f"{volume}_ask_side", volume, 4)
        for days in SPIKE_DAYS:
            derived[f"{volume}_spike_{days}d"] = safe_ratio(volume, f"avg_{days}_day_{volume}", 4)
        derived[f"{kind}_oi_delta_perc"] = safe_ratio(c(interest) - c(before), before, 4)
        derived[f"{kind}_oi_spike_30d"] = safe_ratio(interest, f"avg_30_day_{kind}_oi", 4)
    return typed.withColumns(derived)


def _sweep_columns() -> dict[str, Column]:
    sweep = F.col("option_tx_type") == "sweep"
    out = {}
    for kind in KINDS:
        of_kind = F.col("option_type") == kind
        for measure in ("volume", "premium"):
            out[f"{kind}_sweep_{measure}"] = F.when(sweep & of_kind, F.col(measure))
            for side in ("ask", "bid"):
                at_side = of_kind & (F.col("side") == side)
                out[f"{kind}_{side}_sweep_{measure}"] = F.when(sweep & at_side, F.col(measure))
                if measure == "premium":
                    out[f"{kind}_{side}_premium"] = F.when(at_side, F.col(measure))
    return out


def sweep_premium_rollup(trades: DataFrame) -> DataFrame:
    """Per symbol and day: sweep volume and premium by kind and side (16 sums)."""
    typed = trades.select(
        F.col("underlying_symbol").alias("symbol"),
        DAY,
        "side",
        "option_type",
        transaction_type("upstream_condition_detail").alias("option_tx_type"),
        try_bigint("size").alias("volume"),
        try_double("premium").alias("premium"),
    )
    return typed.groupBy("symbol", DAY).agg(*[F.sum(v).alias(n) for n, v in _sweep_columns().items()])


def option_screener(metrics: DataFrame, sweeps: DataFrame) -> DataFrame:
    """Screener metrics joined with the day's sweeps, plus the sweep ratios."""
    joined = metrics.join(sweeps.withColumnRenamed("symbol", "ticker"), ["ticker", DAY])
    bullish = F.col("call_ask_sweep_volume") + F.col("put_bid_sweep_volume")
    bearish = F.col("call_bid_sweep_volume") + F.col("put_ask_sweep_volume")
    derived = {
        "bullish_sweep_volume": bullish,
        "bullish_sweep_volume_perc": safe_ratio(bullish, "bullish_volume", 4),
        "bearish_sweep_volume_perc": safe_ratio(bearish, "bearish_volume", 4),
    }
    for kind in KINDS:
        derived[f"{kind}_sweep_ask_perc"] = safe_ratio(f"{kind}_ask_sweep_volume", f"{kind}_sweep_volume", 4)
        derived[f"{kind}_sweep_tot_perc"] = safe_ratio(f"{kind}_sweep_volume", f"{kind}_volume", 4)
        derived[f"{kind}_sweep_premium_perc"] = safe_ratio(f"{kind}_sweep_premium", f"{kind}_premium", 4)
    return joined.withColumns(derived).distinct()


# Fixed values of the score: percentile name -> metric (both per kind), the
# weight of a flag, and the percentile from which a percentile itself counts.
PERCENTILES = {
    "{kind}_volume_spike_percentile": "{kind}_volume_spike_30d",
    "{kind}_ask_perc_percentile": "{kind}_ask_perc",
    "{kind}_oi_delta_percentile": "{kind}_oi_delta_perc",
    "{kind}_oi_spike_percentile": "{kind}_oi_spike_30d",
    "{kind}_sweep_volume_ratio_percentile": "{kind}_sweep_tot_perc",
    "{kind}_ask_sweep_ratio_percentile": "{kind}_sweep_ask_perc",
    "{kind}_sweep_premium_ratio_percentile": "{kind}_sweep_premium_perc",
}
FLAG_WEIGHT = 0.5
HIGH_PERCENTILE = 0.6


def percentile_metrics() -> dict[str, str]:
    return {
        name.format(kind=kind): metric.format(kind=kind)
        for name, metric in PERCENTILES.items()
        for kind in KINDS
    }


def _leaning(kind: str) -> Column:
    """Sum of the terms that speak for ``kind`` (call: bullish, put: bearish)."""
    other = "put" if kind == "call" else "call"
    own_way, other_way = ("bullish", "bearish") if kind == "call" else ("bearish", "bullish")
    c = F.col
    flags = [
        c(f"{kind}_volume_spike_30d") > 2,
        c(f"{kind}_ask_perc") > 0.6,
        c(f"{kind}_oi_delta_perc") > 0.1,
        c(f"{kind}_oi_spike_30d") > 1.5,
        c(f"net_{kind}_premium") > 0,
        safe_ratio(f"{kind}_sweep_volume", f"{kind}_volume") > 0.3,
        c(f"{kind}_sweep_ask_perc") > 0.7,
        c(f"{other}_volume_spike_30d") < 1,
        safe_ratio(f"{kind}_sweep_premium", f"{kind}_premium") > 0.5,
        c(f"{kind}_sweep_volume") > 2 * c(f"avg_30_day_{kind}_volume"),
        c(f"{kind}_ask_sweep_premium") > c(f"{kind}_bid_sweep_premium"),
        safe_ratio(f"{own_way}_premium", f"{other_way}_premium") > 2,
        # True for every percentile, which lies in [0, 1]; kept so that a NULL
        # percentile (ignored metric) still differs from a present one.
        c(f"{other}_volume_spike_percentile") < 10,
    ]
    score = F.lit(0.0)
    for flag in flags:
        score = score + F.when(flag, FLAG_WEIGHT).otherwise(0.0)
    for name in PERCENTILES:
        rank = c(name.format(kind=kind))
        score = score + F.when(rank >= HIGH_PERCENTILE, rank).otherwise(0.0)
    return score


def composite_score(
    screener: DataFrame,
    master: DataFrame,
    peers: Sequence[str] = (DAY, "sector"),
    null_metric: str = "last",
) -> DataFrame:
    """Bullish minus bearish evidence, relative to the peers of the same sector.

    ``screener`` is the option screener (one row per ticker and day) and
    ``master`` the symbol master. A NULL metric ranks highest among its peers,
    or takes no part with ``null_metric="ignore"``.
    """
    sectors = master.select(F.col("symbol").alias("ticker"), "sector")
    rows = screener.join(sectors, "ticker")
    # A sector has as many rows on a day as it has listed tickers.
    ranked = peer_percentile(
        rows, percentile_metrics(), list(peers), ["ticker", DAY], 4, null_metric, small_groups=True
    )
    score = round_scaled(_leaning("call") - _leaning("put"), 4)
    return ranked.withColumn("options_composite_score", score)
