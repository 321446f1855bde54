"""The queries in SQL, written independently for a second engine.

Rounding follows the library: ``rs`` scales, rounds and scales back, ``rst``
also removes summation noise first.
"""

from __future__ import annotations

from quotelake.catalog import roles
from quotelake.plans.fundamentals import FUNDAMENTAL_KINDS
from quotelake.plans.master import FUNDAMENTAL_INDUSTRIES, SCREENER_INDUSTRIES, TECHNICAL_INDUSTRIES, TECHNICAL_SECTORS
from quotelake.plans.summary import EXCLUDED_ATTRIBUTE, SUMMARY_ATTRIBUTES


def rs(x: str, n: int) -> str:
    return f"(round(({x})::DOUBLE * {10**n}::DOUBLE) / {10**n}::DOUBLE + 0::DOUBLE)"


def rst(x: str, n: int) -> str:
    return f"(round(round(({x})::DOUBLE * {10**n}::DOUBLE, 6)) / {10**n}::DOUBLE + 0::DOUBLE)"


def ratio(a: str, b: str, n: int) -> str:
    return rs(f"({a})::DOUBLE / nullif(({b})::DOUBLE, 0)", n)


def lst(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def at(values, index: str) -> str:
    return f"({lst(values)})[(({index}) % {len(values)})::INT + 1]"


def whens(column: str, mapping: dict[str, str]) -> str:
    if not mapping:
        return column
    quoted = [(old.replace("'", "''"), new.replace("'", "''")) for old, new in mapping.items()]
    return f"CASE {column} " + " ".join(f"WHEN '{o}' THEN '{n}'" for o, n in quoted) + f" ELSE {column} END"


def with_(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + final


# --- trades --------------------------------------------------------------

CONTRACTS = """contracts AS (
  SELECT *, 'S' || l_suppkey AS sym,
         CASE WHEN l_partkey % 2 = 0 THEN 'call' ELSE 'put' END AS kind,
         ((l_partkey // 2) % 5) * 5 + 50 AS strike,
         DATE '2002-03-15' + (((l_partkey // 10) % 2) * 7)::INT AS exp,
         l_partkey % 20 AS cno
  FROM lineitem)"""
CHAIN = (
    "sym || strftime(exp, '%y%m%d') || CASE kind WHEN 'call' THEN 'C' ELSE 'P' END"
    " || lpad((strike * 1000)::VARCHAR, 8, '0')"
)
TRADES = f"""trades AS (
  SELECT year(l_shipdate) || '0101' AS day, sym, l_suppkey AS supp, {CHAIN} AS chain, kind, strike, cno, exp,
         CASE WHEN l_returnflag = 'A' THEN 'ask' WHEN l_returnflag = 'R' THEN 'bid'
              WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 6 THEN 'no_side' ELSE 'mid' END AS side,
         {at(roles.CONDITIONS, "l_orderkey")} AS cond,
         l_quantity::BIGINT AS size, floor(l_extendedprice)::BIGINT AS premium,
         floor(l_extendedprice / l_quantity) / 100 AS price,
         (l_suppkey * 131 + cno * 977) % 2500 AS oi,
         CASE WHEN l_linenumber <> 5 THEN l_discount + 0.2::DOUBLE END AS iv,
         CASE WHEN l_linenumber <> 5 THEN l_tax * 5 - 0.2::DOUBLE END AS delta,
         CASE WHEN l_linenumber <> 5 THEN l_discount / 10 END AS gamma,
         CASE WHEN l_linenumber <> 5 THEN l_tax END AS vega,
         CASE WHEN l_linenumber <> 5 THEN -l_tax / 2 END AS theta,
         CASE WHEN l_linenumber <> 5 THEN l_discount * l_tax END AS rho,
         CASE WHEN l_linenumber <> 5 THEN l_extendedprice / l_quantity * 0.0098::DOUBLE END AS theo
  FROM contracts)"""


def tx(split: bool) -> str:
    auto, manual = ("auto_multileg", "manual_multileg") if split else ("multileg", "multileg")
    names = ["multileg_a"] * 7 + ["sweep"] * 6 + ["multileg_m"] * 2 + ["standard"] * 4
    labels = {"multileg_a": auto, "multileg_m": manual, "sweep": "sweep", "standard": "standard"}
    return whens("cond", {c: labels[n] for c, n in zip(roles.CONDITIONS, names)})


def _wavg(column: str, n: int) -> str:
    return rst(f"sum({column} * size) / nullif(sum(size), 0)::DOUBLE", n)


CUBE_MEASURES = f"""count(*)::BIGINT AS trade_count, sum(size)::BIGINT AS total_contracts,
         sum(premium)::BIGINT AS total_premium, max(oi) AS open_interest,
         min(price) AS min_price, max(price) AS max_price,
         {_wavg("price", 2)} AS wtd_avg_price, {_wavg("iv", 4)} AS wtd_avg_iv,
         {_wavg("delta", 4)} AS wtd_avg_delta, {_wavg("gamma", 4)} AS wtd_avg_gamma,
         {_wavg("vega", 4)} AS wtd_avg_vega, {_wavg("theta", 4)} AS wtd_avg_theta,
         {_wavg("rho", 4)} AS wtd_avg_rho, {_wavg("theo", 4)} AS wtd_avg_theo"""


def trade_cube(strict: bool) -> str:
    label = (
        "CASE WHEN grouping(side) = 1 THEN 'total' ELSE coalesce(side, 'unknown') END"
        if strict
        else "coalesce(side, 'total')"
    )
    return with_(
        CONTRACTS,
        TRADES,
        """liquid AS (SELECT day, chain FROM trades GROUP BY day, chain
                   HAVING sum(size) >= 100 OR max(oi) >= 100)""",
        f"typed AS (SELECT *, {tx(True)} AS tx FROM trades SEMI JOIN liquid USING (day, chain))",
        final=f"""SELECT day AS file_version_date, sym AS underlying_symbol, chain AS option_chain_id,
         kind AS option_type, strike::DOUBLE AS strike, strftime(exp, '%Y-%m-%d') AS expiry,
         {label} AS side, tx AS option_tx_type, {CUBE_MEASURES}
         FROM typed GROUP BY day, sym, chain, kind, strike, exp, CUBE (side, tx)""",
    )


OI = f"""oi_feed AS (
  SELECT year(l_shipdate) || '0101' AS day, sym, {CHAIN} AS chain, strike, exp, kind, cno,
         (l_suppkey * 131 + cno * 977) % 2500 AS oi,
         coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0)::BIGINT AS vol_now,
         coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0)::BIGINT AS vol_then
  FROM contracts GROUP BY ALL)"""
BASE = f"""base AS (
  SELECT day AS file_version_date, chain AS option_symbol, sym AS underlying_symbol, strike::DOUBLE AS strike,
         strftime(exp, '%Y%m%d')::INT AS expiry, CASE kind WHEN 'call' THEN 'C' ELSE 'P' END AS option_typ,
         CASE cno WHEN 3 THEN 13 WHEN 4 THEN NULL ELSE cno END::INT AS days_to_expiry,
         vol_now AS curr_chain_vol, vol_then AS prev_chain_vol, vol_now - vol_then AS chain_vol_diff,
         oi AS curr_oi, oi + vol_then - 60 AS prev_oi, 60 - vol_then AS oi_diff,
         {ratio("vol_now", "oi", 2)} AS unusual_curr_vol,
         {ratio("vol_now - vol_then", "oi", 2)} AS unusual_diff_vol
  FROM oi_feed)"""
CHAIN_CUBE = f"""chain_cube AS (
  SELECT t.day AS file_version_date, t.sym AS underlying_symbol, t.chain AS option_chain_id, t.kind AS option_type,
         t.strike::DOUBLE AS strike, strftime(t.exp, '%Y%m%d')::INT AS expiry,
         coalesce(side, 'total') AS side,
         CASE WHEN (t.kind = 'call' AND side = 'ask') OR (t.kind = 'put' AND side = 'bid') THEN 'bull'
              WHEN (t.kind = 'call' AND side = 'bid') OR (t.kind = 'put' AND side = 'ask') THEN 'bear'
              WHEN side = 'mid' THEN 'neutral' ELSE 'total' END AS bull_bear_flg,
         tx AS option_tx_type, {CUBE_MEASURES}
  FROM (SELECT *, {tx(False)} AS tx FROM trades
        WHERE (day, chain) IN (SELECT (file_version_date, option_symbol) FROM base)) t
  GROUP BY t.day, t.sym, t.chain, t.kind, t.strike, t.exp, CUBE (side, tx))"""

STRIKE_GROUPS = {
    "total": ("total", "IS NULL"),
    "bull": ("bull", "IS NULL"),
    "bear": ("bear", "IS NULL"),
    "sweep": ("total", "= 'sweep'"),
    "bull_sweep": ("bull", "= 'sweep'"),
    "bear_sweep": ("bear", "= 'sweep'"),
    "ml": ("total", "= 'multileg'"),
}
STRIKE_MEASURES = {"trades": "trade_count", "vol": "total_contracts", "prem": "total_premium"}
STRIKE_NAMES = [f"{g}_strike_{m}" for g in STRIKE_GROUPS for m in STRIKE_MEASURES]
STRIKES = (
    "strikes AS (SELECT file_version_date, underlying_symbol, strike, expiry, "
    + ", ".join(
        f"sum({measure}) FILTER (bull_bear_flg = '{flag}' AND option_tx_type {kind})::BIGINT AS {g}_strike_{m}"
        for g, (flag, kind) in STRIKE_GROUPS.items()
        for m, measure in STRIKE_MEASURES.items()
    )
    + " FROM chain_cube GROUP BY ALL)"
)


def _pivot_columns() -> list[str]:
    def pick(side: str, kind: str, measure: str, name: str) -> str:
        return f"max({measure}) FILTER (c.side = '{side}' AND c.option_tx_type {kind}) AS {name}"

    n = "IS NULL"
    out = [
        pick("total", n, "trade_count", "total_trades"),
        pick("ask", n, "trade_count", "trades_at_ask"),
        pick("bid", n, "trade_count", "trades_at_bid"),
    ]
    for kind, total, pre in [(n, "total_vol", ""), ("= 'sweep'", "total_sweep_vol", "sweep_"), ("= 'multileg'", "total_ml_vol", "ml_")]:
        out += [pick("total", kind, "total_contracts", total)]
        out += [pick(s, kind, "total_contracts", f"{pre}{s}_vol") for s in ("ask", "bid")]
    out += [pick("total", n, "total_premium", "total_premium")]
    out += [pick(s, n, "total_premium", f"total_premium_at_{s}") for s in ("ask", "bid")]
    for kind, pre in [("= 'sweep'", "sweep"), ("= 'multileg'", "ml")]:
        out += [pick("total", kind, "total_premium", f"total_{pre}_premium")]
        out += [pick(s, kind, "total_premium", f"{pre}_{s}_premium") for s in ("ask", "bid")]
    out += [pick("total", n, m, m) for m in ("min_price", "max_price")]
    out += [pick("total", n, f"wtd_avg_{m}", f"total_avg_{m}") for m in ("price", "delta", "gamma")]
    return out


BASE_FACTS = (
    "days_to_expiry curr_chain_vol prev_chain_vol chain_vol_diff curr_oi prev_oi oi_diff "
    "unusual_diff_vol unusual_curr_vol"
).split()
ANALYTICS = f"""analytics AS (
  SELECT c.file_version_date, c.underlying_symbol, c.option_chain_id, c.option_type, c.strike, c.expiry,
         {", ".join(f"max(b.{f}) AS {f}" for f in BASE_FACTS)},
         max(CASE WHEN b.unusual_diff_vol > 1 OR b.unusual_curr_vol > 2 THEN 'Y' ELSE 'N' END) AS unusual_vol_flg,
         {", ".join(_pivot_columns())},
         {", ".join(f"max(s.{m}) AS {m}" for m in STRIKE_NAMES)},
         max(s.bull_strike_prem) - max(s.bear_strike_prem) AS net_strike_prem
  FROM chain_cube c
  JOIN strikes s USING (file_version_date, underlying_symbol, strike, expiry)
  JOIN base b ON b.file_version_date = c.file_version_date AND b.option_symbol = c.option_chain_id
  GROUP BY c.file_version_date, c.underlying_symbol, c.option_chain_id, c.option_type, c.strike, c.expiry)"""
CHAIN_CTES = (CONTRACTS, TRADES, OI, BASE, CHAIN_CUBE)

CONTRACT_Z = {
    "chain_vol_diff_zscore": "chain_vol_diff",
    "chain_oi_diff_zscore": "oi_diff",
    "chain_trades_zscore": "total_trades",
    "chain_sweep_vol_zscore": "total_sweep_vol",
    "chain_prem_zscore": "total_premium",
    "chain_sweep_prem_zscore": "total_sweep_premium",
}
STRIKE_Z = (
    "total_strike_prem sweep_strike_vol sweep_strike_prem bull_strike_trades bull_strike_vol "
    "bull_strike_prem net_strike_prem"
).split()


def _z(column: str, window: str) -> str:
    return rst(f"({column} - avg({column}) OVER {window}) / nullif(stddev_samp({column}) OVER {window}, 0)", 2)


def chain_zscores(columns: str, base_filter: str = "") -> str:
    base = BASE if not base_filter else BASE[:-1] + f" WHERE {base_filter})"
    strike_key = "file_version_date, underlying_symbol, expiry, strike"
    return with_(
        CONTRACTS,
        TRADES,
        OI,
        base,
        CHAIN_CUBE,
        STRIKES,
        ANALYTICS,
        f"""strike_scores AS (
          SELECT {strike_key}, {", ".join(f"{_z(m, 'w')} AS {m}_zscore" for m in STRIKE_Z)}
          FROM (SELECT DISTINCT {strike_key}, {", ".join(STRIKE_Z)} FROM analytics)
          WINDOW w AS (PARTITION BY file_version_date, underlying_symbol, expiry))""",
        final=f"""SELECT {columns}, {", ".join(f"{_z(m, 'w')} AS {o}" for o, m in CONTRACT_Z.items())},
          {", ".join(f"{m}_zscore" for m in STRIKE_Z)}
          FROM analytics a JOIN strike_scores USING ({strike_key})
          WINDOW w AS (PARTITION BY file_version_date, underlying_symbol, option_type, expiry)""",
    )


# --- screener ------------------------------------------------------------


def _screener_feed() -> str:
    parts = []
    for k in ("call", "put"):
        f = f"kind = '{k}'"
        parts.append(f"coalesce(sum(size) FILTER ({f}), 0)::BIGINT AS {k}_volume")
        parts.append(f"coalesce(sum(premium) FILTER ({f}), 0)::BIGINT AS {k}_premium")
        parts.append(f"coalesce(sum(oi) FILTER ({f}), 0)::BIGINT AS {k}_open_interest")
        for s in ("ask", "bid"):
            parts.append(f"coalesce(sum(size) FILTER ({f} AND side = '{s}'), 0)::BIGINT AS {k}_volume_{s}_side")
            parts.append(f"coalesce(sum(premium) FILTER ({f} AND side = '{s}'), 0)::BIGINT AS {k}_{s}_paid")
    return f"feed_sums AS (SELECT day, sym, supp, {', '.join(parts)} FROM trades GROUP BY day, sym, supp)"


def _screener_typed() -> str:
    cols = [
        "sym AS ticker",
        "day AS file_version_date",
        "supp",
        f"{rs('CASE WHEN supp % 3 = 0 THEN 0 ELSE put_volume / (call_volume + 1) END', 4)} AS feed_ratio",
        "call_open_interest + put_open_interest AS total_open_interest",
        "call_ask_paid + put_bid_paid AS bullish_premium",
        "call_bid_paid + put_ask_paid AS bearish_premium",
        f"{rs('supp * 10.5::DOUBLE', 4)} AS avg30_volume",
        f"{rs('0.2::DOUBLE + (supp % 7) / 16', 4)} AS volatility",
        f"{rs('0.1::DOUBLE + (supp % 5) / 8', 4)} AS iv30d",
        f"{rs('(supp % 4) / 4', 4)} AS iv30d_1m",
        f"{rs('(supp % 100) / 8', 4)} AS iv_rank",
        f"{at(roles.OPTION_SECTORS, 'supp')} AS feed_sector",
    ]
    for k in ("call", "put"):
        cols += [f"{k}_volume{s}" for s in ("", "_ask_side", "_bid_side")]
        cols += [f"{k}_premium", f"{k}_open_interest", f"{k}_ask_paid - {k}_bid_paid AS net_{k}_premium"]
        cols += [f"{k}_open_interest - {k}_open_interest % 100 AS prev_{k}_oi"]
        for days, mod in ((3, 2), (7, 3), (30, 4)):
            cols.append(f"{rs(f'{k}_volume / (1 + supp % {mod})', 4)} AS avg_{days}_day_{k}_volume")
        cols.append(f"{rs(f'{k}_open_interest / (1 + supp % 3)', 4)} AS avg_30_day_{k}_oi")
    return f"typed AS (SELECT {', '.join(cols)} FROM feed_sums)"


def _metrics() -> str:
    both = "call_volume + put_volume"
    bull = "call_volume_ask_side + put_volume_bid_side"
    bear = "call_volume_bid_side + put_volume_ask_side"
    cols = [
        f"CASE WHEN feed_ratio = 0 THEN {ratio('put_volume', 'call_volume', 4)} ELSE feed_ratio END AS put_call_ratio",
        f"{both} AS options_tot_volume",
        f"{bull} AS bullish_volume",
        f"{ratio(bull, both, 4)} AS bullish_volume_perc",
        f"{bear} AS bearish_volume",
        f"{ratio(bear, both, 4)} AS bearish_volume_perc",
        f"{ratio('call_volume_ask_side - call_volume_bid_side', both, 4)} AS call_skew",
        f"{ratio('put_volume_bid_side - put_volume_ask_side', both, 4)} AS put_skew",
        f"{ratio('volatility - iv30d', 'volatility', 4)} AS iv_spike_d",
        f"{ratio('volatility - iv30d_1m', 'volatility', 4)} AS iv_spike_30d",
    ]
    for k in ("call", "put"):
        cols.append(f"{ratio(f'{k}_volume_ask_side', f'{k}_volume', 4)} AS {k}_ask_perc")
        for d in (3, 7, 30):
            cols.append(f"{ratio(f'{k}_volume', f'avg_{d}_day_{k}_volume', 4)} AS {k}_volume_spike_{d}d")
        cols.append(f"{ratio(f'{k}_open_interest - prev_{k}_oi', f'prev_{k}_oi', 4)} AS {k}_oi_delta_perc")
        cols.append(f"{ratio(f'{k}_open_interest', f'avg_30_day_{k}_oi', 4)} AS {k}_oi_spike_30d")
    return f"metrics AS (SELECT * EXCLUDE (feed_ratio, supp, feed_sector), {', '.join(cols)} FROM typed)"


def _sweeps() -> str:
    cols = []
    for k in ("call", "put"):
        f = f"kind = '{k}'"
        for m, expr in (("volume", "sum(size)"), ("premium", "sum(premium)")):
            cast = "BIGINT" if m == "volume" else "DOUBLE"
            cols.append(f"({expr} FILTER ({f} AND tx = 'sweep'))::{cast} AS {k}_sweep_{m}")
            for s in ("ask", "bid"):
                cols.append(f"({expr} FILTER ({f} AND tx = 'sweep' AND side = '{s}'))::{cast} AS {k}_{s}_sweep_{m}")
        for s in ("ask", "bid"):
            cols.append(f"(sum(premium) FILTER ({f} AND side = '{s}'))::DOUBLE AS {k}_{s}_premium")
    return f"""sweeps AS (SELECT sym AS symbol, day AS file_version_date, {", ".join(cols)}
               FROM (SELECT *, {tx(True)} AS tx FROM trades) GROUP BY sym, day)"""


def _option_screener() -> str:
    bull = "call_ask_sweep_volume + put_bid_sweep_volume"
    bear = "call_bid_sweep_volume + put_ask_sweep_volume"
    cols = [
        f"{bull} AS bullish_sweep_volume",
        f"{ratio(bull, 'bullish_volume', 4)} AS bullish_sweep_volume_perc",
        f"{ratio(bear, 'bearish_volume', 4)} AS bearish_sweep_volume_perc",
    ]
    for k in ("call", "put"):
        cols.append(f"{ratio(f'{k}_ask_sweep_volume', f'{k}_sweep_volume', 4)} AS {k}_sweep_ask_perc")
        cols.append(f"{ratio(f'{k}_sweep_volume', f'{k}_volume', 4)} AS {k}_sweep_tot_perc")
        cols.append(f"{ratio(f'{k}_sweep_premium', f'{k}_premium', 4)} AS {k}_sweep_premium_perc")
    return f"""screener AS (SELECT DISTINCT m.*, s.* EXCLUDE (symbol, file_version_date), {", ".join(cols)}
               FROM metrics m JOIN sweeps s ON s.symbol = m.ticker AND s.file_version_date = m.file_version_date)"""


SCREENER_CTES = (CONTRACTS, TRADES, _screener_feed(), _screener_typed(), _metrics())


# --- symbol master -------------------------------------------------------

MASTER = f"""screener_rows AS (
  SELECT 'S' || (c_custkey // 3) AS symbol, CASE WHEN c_nationkey = 3 THEN '-' ELSE c_name END AS co_name,
         CASE WHEN c_nationkey = 7 THEN NULL ELSE {at(roles.SCREENER_SECTORS, "c_custkey")} END AS sector,
         {at(roles.SCREENER_INDUSTRIES, "c_nationkey")} AS industry
  FROM customer),
candidates AS (
  SELECT symbol, CASE WHEN length(co_name) <= 2 THEN NULL ELSE co_name END AS name,
         CASE WHEN length(sector) <= 1 AND length(industry) <= 1 THEN NULL
              WHEN length(sector) <= 1 AND length(industry) > 1
              THEN max({whens("sector", {"Financial Services": "Financial"})}) OVER (PARTITION BY industry)
              ELSE {whens("sector", {"Financial Services": "Financial"})} END AS sector,
         CASE WHEN length(industry) <= 1 THEN NULL ELSE {whens("industry", SCREENER_INDUSTRIES)} END AS industry,
         1 AS priority
  FROM screener_rows
  UNION ALL
  SELECT 'S' || s_suppkey, CASE WHEN length(s_name) > 2 THEN s_name END,
         nullif({at(["Technology", "-", "Energy"], "s_suppkey")}, '-'),
         CASE WHEN length(i) > 1 THEN {whens("i", FUNDAMENTAL_INDUSTRIES)} END, 2
  FROM (SELECT *, {at(roles.INDUSTRIES, "s_suppkey")} AS i FROM supplier)
  UNION ALL
  SELECT 'S' || (p_partkey // 2), CASE WHEN length(p_name) > 2 THEN p_name END,
         CASE WHEN length(s) > 1 THEN {whens("s", TECHNICAL_SECTORS)} END,
         CASE WHEN length(i) > 1 THEN {whens("i", TECHNICAL_INDUSTRIES)} END, 3
  FROM (SELECT *, {at(roles.TECH_SECTORS, "p_partkey")} AS s, {at(roles.TECH_INDUSTRIES, "p_partkey")} AS i FROM part)
  UNION ALL
  SELECT 'S' || o_custkey,
         array_to_string(list_transform(string_split(lower(upper(o_orderpriority) || '  HOLDINGS ' || o_orderstatus), ' '),
                                        lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' '),
         {whens("s", {"Financial Services": "Financial"})}, NULL, 4
  FROM (SELECT *, {at(roles.OPTION_SECTORS, "o_custkey")} AS s FROM orders)),
master AS (
  SELECT DISTINCT symbol, coalesce(name, max_name) AS name, sector, industry
  FROM (SELECT *, max(name) OVER (PARTITION BY symbol) AS max_name,
               rank() OVER (PARTITION BY symbol ORDER BY priority, sector NULLS LAST, industry NULLS LAST,
                            name DESC NULLS LAST) AS place
        FROM candidates)
  WHERE place = 1)"""


def composite_score() -> str:
    metric = {
        "{k}_volume_spike_percentile": "{k}_volume_spike_30d",
        "{k}_ask_perc_percentile": "{k}_ask_perc",
        "{k}_oi_delta_percentile": "{k}_oi_delta_perc",
        "{k}_oi_spike_percentile": "{k}_oi_spike_30d",
        "{k}_sweep_volume_ratio_percentile": "{k}_sweep_tot_perc",
        "{k}_ask_sweep_ratio_percentile": "{k}_sweep_ask_perc",
        "{k}_sweep_premium_ratio_percentile": "{k}_sweep_premium_perc",
    }
    ranks, names = [], []
    for k in ("call", "put"):
        for name, source in metric.items():
            names.append(name.format(k=k))
            order = f"percent_rank() OVER (PARTITION BY m.sector, file_version_date ORDER BY {source.format(k=k)} NULLS LAST)"
            ranks.append(f"{rs(order, 4)} AS {names[-1]}")

    def side(k: str, other: str, own: str, opposite: str) -> str:
        flags = [
            f"{k}_volume_spike_30d > 2",
            f"{k}_ask_perc > 0.6::DOUBLE",
            f"{k}_oi_delta_perc > 0.1::DOUBLE",
            f"{k}_oi_spike_30d > 1.5::DOUBLE",
            f"net_{k}_premium > 0",
            f"{k}_sweep_volume / nullif({k}_volume, 0) > 0.3::DOUBLE",
            f"{k}_sweep_ask_perc > 0.7::DOUBLE",
            f"{other}_volume_spike_30d < 1",
            f"{k}_sweep_premium / nullif({k}_premium, 0) > 0.5::DOUBLE",
            f"{k}_sweep_volume > 2 * avg_30_day_{k}_volume",
            f"{k}_ask_sweep_premium > {k}_bid_sweep_premium",
            f"{own}_premium / nullif({opposite}_premium, 0) > 2",
            f"{other}_volume_spike_percentile < 10",
        ]
        terms = [f"coalesce(({f})::INT, 0) * 0.5::DOUBLE" for f in flags]
        terms += [f"coalesce(CASE WHEN {n} >= 0.6::DOUBLE THEN {n} END, 0)" for n in (m.format(k=k) for m in metric)]
        return " + ".join(terms)

    bull, bear = side("call", "put", "bullish", "bearish"), side("put", "call", "bearish", "bullish")
    return with_(
        *SCREENER_CTES,
        _sweeps(),
        _option_screener(),
        MASTER,
        f"ranked AS (SELECT s.*, m.sector, {', '.join(ranks)} FROM screener s JOIN master m ON m.symbol = s.ticker)",
        final=f"""SELECT ticker, file_version_date, sector, {", ".join(names)},
                 {rs(f"({bull}) - ({bear})", 4)} AS options_composite_score FROM ranked""",
    )


# --- typed text ----------------------------------------------------------


def _fundamental(name: str, kind: str, i: int) -> str:
    if kind.startswith("yield:"):
        of = kind.split(":")[1]
        text = roles.fundamental_text("payout", list(FUNDAMENTAL_KINDS).index(of))
        return f"try_cast(nullif(regexp_extract({text}, '\\(([^%]*)%', 1), '') AS FLOAT)::DOUBLE"
    source = roles.fundamental_source_kind(name, kind)
    text = roles.fundamental_text(source, i)
    if kind == "text":
        return text
    if kind == "flag":
        return f"(length({text}) = 2)::INT"
    if kind == "number":
        return f"try_cast({text} AS FLOAT)::DOUBLE"
    if kind == "percent":
        return f"try_cast(replace({text}, '%', '') AS FLOAT)::DOUBLE"
    if kind in ("magnitude", "volume"):
        number = f"try_cast(left({text}, -1) AS FLOAT)"
        return f"""(CASE right({text}, 1) WHEN 'M' THEN {number} WHEN 'K' THEN ({number} / 1000::FLOAT)::FLOAT
                 WHEN 'B' THEN ({number} * 1000::FLOAT)::FLOAT END)::DOUBLE"""
    return f"strftime(try_strptime({text}, '%b %d, %Y'), '%Y%m%d')"


def _fundamentals() -> str:
    cols = [f"{_fundamental(n, k, i)} AS {n}" for i, (n, k) in enumerate(FUNDAMENTAL_KINDS.items())]
    return f"fundamentals AS (SELECT {', '.join(cols)} FROM (SELECT *, {', '.join(roles.NUMBERS)} FROM (SELECT *, {roles.CENTS} FROM customer)))"


RATINGS = """SELECT DISTINCT 'D' || doc_id AS symbol, source AS status, lang AS rating_by,
  CASE WHEN doc_id % 13 <> 0 THEN strftime(DATE '2024-01-01' + (doc_id % 400)::INT, '%Y%m%d') END AS ratings_date,
  regexp_replace(CASE WHEN doc_id % 11 = 0 THEN '' ELSE replace(text, ' ', '→') END, '→', '. . .') AS price_target,
  CASE WHEN doc_id % 11 = 0 OR length(text) = 0 THEN 'N' ELSE 'Y' END AS pt_flag,
  '20250101' AS file_version_date
FROM documents"""


# --- JSON feeds ----------------------------------------------------------

ANALYST = with_(
    """users AS (
      SELECT user_id, max(event_type) AS top_event, count(*) FILTER (event_type = 'purchase') AS buy,
             count(*) FILTER (event_type = 'view') AS hold, count(*) FILTER (event_type = 'error') AS sell,
             sum((props->>'$.k')::BIGINT)::DOUBLE AS k_sum, max((props->>'$.k')::BIGINT)::DOUBLE AS k_max
      FROM events GROUP BY user_id)""",
    final="""SELECT 'U' || user_id AS ticker, top_event AS analyst_consensus, buy::DOUBLE AS buy_count,
      hold::DOUBLE AS hold_count, sell::DOUBLE AS sell_count,
      CASE WHEN user_id % 4 <> 0 THEN k_sum ELSE 0 END AS "tipRanksScore", 0::DOUBLE AS analyst_consensus_rating,
      buy::DOUBLE AS blogger_consensus_rating, 0::DOUBLE AS tr_insider_rating, 0::DOUBLE AS tr_hedge_fund_rating,
      0::DOUBLE AS tr_news_rating, 0::DOUBLE AS tr_investor_rating,
      CASE WHEN user_id % 4 <> 0 THEN sell ELSE 0 END::DOUBLE AS tr_insider_score, 0::DOUBLE AS tr_hedge_fund_score,
      0::DOUBLE AS tr_news_score, 0::DOUBLE AS tr_investor_score, k_max AS tr_avg_price_target,
      k_max * 2 AS tr_high_pricetarget, NULL::DOUBLE AS tr_low_pricetarget FROM users""",
)

EARNINGS = with_(
    """sums AS (SELECT 'C' || o_custkey AS s, strftime(o_orderdate, '%Y%m01') AS day, o_orderstatus = 'O' AS is_open,
         sum(floor(o_totalprice)) AS sales, max(o_orderdate) AS d FROM orders GROUP BY ALL)""",
    "reported AS (SELECT * FROM sums WHERE NOT is_open)",
    "upcoming AS (SELECT * FROM sums WHERE is_open)",
    final="""SELECT coalesce(r.s, u.s) AS "Symbol", NULL::VARCHAR AS "ActualNetIncome", NULL::VARCHAR AS "ActualEPS",
      NULL::VARCHAR AS "EstimatedNetIncome", year(r.d) || 'Q' || quarter(r.d) AS "FiscalPeriod",
      NULL::VARCHAR AS "EstimatedEPS", strftime(r.d, '%Y-%m-%d') AS "EarningsDate", NULL::VARCHAR AS "EstimatedSales",
      r.sales::BIGINT::VARCHAR AS "ActualSales", strftime(u.d, '%Y-%m-%d') AS "Upcoming_EarningsDate",
      CASE WHEN u.s IS NOT NULL THEN 'confirmed' END AS "Upcoming_EarningsType",
      u.sales::BIGINT::VARCHAR AS "Upcoming_EstimatedSales", NULL::VARCHAR AS "Upcoming_EstimatedNetIncome",
      NULL::VARCHAR AS "Upcoming_EstimatedEPS", coalesce(r.day, u.day) AS file_version_date
      FROM reported r FULL JOIN upcoming u ON r.s = u.s AND r.day = u.day""",
)

TECHNICAL = with_(
    """files AS (
      SELECT event_id, user_id, strftime(ts, '%Y%m%d') AS day,
             CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS header, props->>'$.k' AS k,
             CASE event_id % 4 WHEN 0 THEN 'large' WHEN 1 THEN 'mid' WHEN 2 THEN 'small' ELSE 'etf' END AS cap
      FROM events)""",
    """rows_of AS (
      SELECT day, header, cap, 'U' || user_id AS symbol, k AS sctr, NULL AS vol FROM files
      UNION ALL SELECT day, header, cap, 'E' || event_id, NULL, '1' FROM files)""",
    final="""SELECT coalesce(header, min(header) OVER (PARTITION BY day)) AS "date", symbol,
      NULL::VARCHAR AS "marketCap", vol, NULL::VARCHAR AS name, sctr AS "SCTR", NULL::VARCHAR AS delta,
      NULL::VARCHAR AS industry, NULL::VARCHAR AS sector, NULL::VARCHAR AS close, cap AS marketcaptype,
      day AS file_version_date FROM rows_of""",
)

# America/New_York within the data: standard time until 10 March 2024 07:00
# UTC, daylight time until 3 November 06:00, standard time until 9 March 2025.
BARS = """bars AS (
  SELECT event_id, value AS o, value + 1 AS h, value - 1 AS l, value * 2 AS c, user_id::DOUBLE AS v,
         make_timestamp(((epoch_us(ts) // 1000) + (event_id % 365) * 86400000) * 1000) AS utc
  FROM events),
local_bars AS (
  SELECT *, CASE WHEN utc >= TIMESTAMP '2024-03-10 07:00:00' AND utc < TIMESTAMP '2024-11-03 06:00:00' THEN 4
                 ELSE 5 END AS behind,
         utc - to_hours(behind) AS et FROM bars),
bar_rows AS (
  SELECT event_id, strftime(et, '%Y-%m-%d %H:%M:%S') || '-0' || behind || '00' AS "date",
         o AS open, h AS high, l AS low, c AS close, v AS volume,
         CASE WHEN hour(et) * 60 + minute(et) BETWEEN 570 AND 960 THEN 'Y' ELSE 'N' END AS regular_trading
  FROM local_bars)"""


# --- flow ----------------------------------------------------------------

KEPT = "DATE '2001-12-31' - flow_date BETWEEN 0 AND 40 AND exp_date >= DATE '2001-12-31'"
KEPT_AFTER_CLOSE = "DATE '2002-01-04' - flow_date BETWEEN 0 AND 40 AND exp_date > DATE '2002-01-04'"
PRINTS = f"""prints AS (
  SELECT day AS flow_day, day - 0 AS flow_date, exp2 AS exp_date,
         strftime(day, '%m/%d/%Y') AS flow_imp_dt, l_orderkey || ':' || l_linenumber AS exec_tm, sym AS tick_symb,
         strftime(exp2, '%m/%d/%Y') AS opts_exp, strike::DECIMAL(10,2) AS opts_strk, upper(kind) AS opts_typ,
         (strike + l_orderkey % 5 - 2)::DECIMAL(10,2) AS tick_spot, {at(roles.TRANSACTIONS, "l_linenumber")} AS trans_typ,
         (floor(l_extendedprice / l_quantity) / 100)::DECIMAL(10,2) AS opts_price,
         l_discount::DECIMAL(10,2) AS iv, l_quantity::DECIMAL(10,2) AS opts_vol,
         'Industry ' || (l_suppkey % 8) AS tick_indstry,
         CASE WHEN l_suppkey % 5 = 0 THEN 'True' ELSE 'False' END AS etf_flg,
         CASE WHEN (l_orderkey + l_linenumber) % 23 <> 0 THEN {at(roles.FLOW_SIDES, "l_orderkey + l_linenumber")} END AS raw_side,
         (l_suppkey * 131 + cno * 977 + dayofyear(day)) % 300 AS opts_oi
  FROM (SELECT *, DATE '2001-12-31' - ((DATE '2001-12-31' - l_shipdate::DATE) % 60)::INT AS day,
               DATE '2001-12-31' + ((cno % 5) * 7 - 3)::INT AS exp2 FROM contracts)),
recent AS (
  SELECT *, regexp_replace(raw_side, '_', '') AS bare FROM prints
  WHERE {KEPT}),
clean AS (
  SELECT DISTINCT tick_symb, exec_tm, opts_exp, opts_strk, opts_typ, opts_oi, iv, flow_imp_dt, tick_indstry, etf_flg,
         opts_price, opts_vol, trans_typ, tick_spot, flow_date, exp_date,
         CASE WHEN raw_side = '' OR raw_side = 'nan' THEN 'M' WHEN bare IN ('A', 'AA') THEN 'A'
              WHEN bare IN ('B', 'BB') THEN 'B' ELSE bare END AS dtls_side,
         CASE WHEN (opts_typ = 'CALL' AND bare LIKE '%A%') OR (opts_typ = 'PUT' AND bare LIKE '%B%') THEN 'Bullish'
              WHEN (opts_typ = 'CALL' AND bare LIKE '%B%') OR (opts_typ = 'PUT' AND bare LIKE '%A%') THEN 'Bearish'
              ELSE 'Others' END AS bull_side,
         CASE WHEN (opts_typ = 'CALL') = (tick_spot >= opts_strk) OR tick_spot = opts_strk
              THEN 'ITM' ELSE 'OTM' END AS moneyness
  FROM recent WHERE trans_typ NOT LIKE '%ML%')"""

FLOW_WINDOWS = """WINDOW cd AS (PARTITION BY flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ),
  cs AS (PARTITION BY flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ, dtls_side),
  cm AS (PARTITION BY flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ, dtls_side, moneyness),
  sd AS (PARTITION BY tick_symb, flow_imp_dt),
  ca AS (PARTITION BY tick_symb, opts_exp, opts_strk, opts_typ)"""


def _contract_stats() -> str:
    prem = "opts_price * opts_vol * 100"
    cols = [
        f"sum({prem}) OVER cd AS opts_prem_imp_dt",
        "sum(opts_vol) OVER cd AS opts_vol_imp_dt",
        f"sum({prem}) OVER cs AS opts_prem_side_imp_dt",
        "sum(opts_vol) OVER cs AS opts_vol_side_imp_dt",
        f"sum({prem}) OVER cm AS opts_prem_mny_imp_dt",
        "sum(opts_vol) OVER cm AS opts_vol_mny_imp_dt",
        f"{rst('(sum(iv) OVER cs)::DOUBLE / count(iv) OVER cs', 4)} AS opts_iv_imp_dt",
        "sum(opts_vol) FILTER (opts_typ = 'CALL') OVER sd AS call_vol_i",
        "sum(opts_vol) FILTER (opts_typ = 'PUT') OVER sd AS put_vol_i",
        "sum(opts_vol) OVER sd AS tot_vol_i",
    ]
    for scope, w in (("tsei", "cd"), ("tse", "ca")):
        for measure, value in (("vol", "opts_vol"), ("prem", prem)):
            for side, letter in (("ask", "A"), ("bid", "B"), ("mid", "M")):
                part = f"coalesce(sum({value}) FILTER (dtls_side LIKE '%{letter}%') OVER {w}, 0)"
                cols.append(f"{part} AS {side}_{measure}_{scope}")
                share = rst(f"({part})::DOUBLE / nullif((sum({value}) OVER {w})::DOUBLE, 0)", 4)
                cols.append(f"coalesce({share}, 0) AS {side}_{measure}_{scope}_perc")
    return f"""contract_stats AS (
      SELECT DISTINCT flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ, NULL::VARCHAR AS er_date, etf_flg, dtls_side,
             bull_side, tick_indstry, opts_oi, {", ".join(cols)} FROM clean {FLOW_WINDOWS})"""


def _doubles(columns: list[str]) -> str:
    return ", ".join(f"{c}::DOUBLE AS {c}" for c in columns)


FLOW_SUMS = (
    "opts_prem_imp_dt opts_vol_imp_dt opts_prem_side_imp_dt opts_vol_side_imp_dt opts_prem_mny_imp_dt "
    "opts_vol_mny_imp_dt opts_strk opts_oi"
).split() + [f"{s}_{m}_{x}" for x in ("tsei", "tse") for m in ("vol", "prem") for s in ("ask", "bid", "mid")]

HISTORY = f"""daily_oi AS (
  SELECT tick_symb, opts_exp, opts_strk, opts_typ, flow_imp_dt, flow_date, opts_oi, sum(opts_vol) AS v
  FROM recent GROUP BY ALL),
history AS (
  SELECT *, lag(opts_oi) OVER w AS prev_oi, lead(opts_oi) OVER w AS nextday_oi,
         max(CASE WHEN flow_date = last_day THEN opts_oi END) OVER (PARTITION BY tick_symb, opts_exp, opts_strk, opts_typ) AS last_oi,
         sum(v) OVER (PARTITION BY tick_symb, opts_exp, opts_strk, opts_typ, flow_imp_dt) AS tot_vol
  FROM (SELECT *, max(flow_date) OVER (PARTITION BY tick_symb, opts_exp, opts_strk, opts_typ) AS last_day FROM daily_oi)
  WINDOW w AS (PARTITION BY tick_symb, opts_exp, opts_strk, opts_typ ORDER BY flow_date, opts_oi))"""


def _attribute_rows(source: str, key: str, prefix: str) -> str:
    names = [*SUMMARY_ATTRIBUTES, EXCLUDED_ATTRIBUTE]
    balance, name_col, nation_col = (f"{key[0]}_{c}" for c in ("acctbal", "name", "nationkey"))
    cells = []
    for i, name in enumerate(names[:-1]):
        text = roles.attribute_text(name, i, balance)
        cells.append(
            f"CASE WHEN cents % {len(names)} <> {i} AND {text} <> '-' THEN replace({text}, '%', '') END AS \"{name}\""
        )
    return f"""summary AS (
      SELECT {at(roles.OPTION_SECTORS, key)} AS sector, {name_col} AS companyname, n_name AS industry,
             '{prefix}' || {key} AS symbol, {", ".join(cells)}
      FROM (SELECT *, {', '.join(roles.NUMBERS)} FROM (SELECT *, {roles.cents_of(balance)} FROM {source}))
      JOIN nation ON n_nationkey = {nation_col})"""


def flow_stats() -> str:
    text = {
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
    percent = {
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
    perc = [f"{s}_{m}_{x}_perc" for x in ("tsei", "tse") for m in ("vol", "prem") for s in ("ask", "bid", "mid")]
    sums = [f"{s}_{m}_{x}" for x in ("tsei", "tse") for m in ("vol", "prem") for s in ("ask", "bid", "mid")]
    week_end = "({d} + (7 - isodow({d}))::INT)"
    weeks = f"({week_end.format(d='exp_day')} - {week_end.format(d='''DATE '2002-01-01' ''')}) // 7 + 1"
    half = "try_cast(split_part(volatility, ' ', {i}) AS DECIMAL(10,4))::DOUBLE / 100"
    return with_(
        CONTRACTS,
        PRINTS,
        _contract_stats(),
        HISTORY,
        _attribute_rows("supplier", "s_suppkey", "S"),
        """signals AS (
          SELECT s.*, h.prev_oi, h.nextday_oi, h.last_oi,
                 max(CASE WHEN opts_vol_imp_dt > s.opts_oi THEN 'Yes' ELSE 'No' END) OVER d AS unusual_flg,
                 row_number() OVER (PARTITION BY flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ
                   ORDER BY opts_vol_side_imp_dt DESC, dtls_side NULLS LAST, bull_side, s.opts_oi, h.prev_oi NULLS LAST,
                            h.nextday_oi NULLS LAST, opts_vol_mny_imp_dt, opts_prem_mny_imp_dt, etf_flg, tick_indstry) AS place
          FROM contract_stats s
          LEFT JOIN (SELECT DISTINCT flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ, prev_oi, nextday_oi, last_oi
                     FROM history) h USING (flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ)
          WINDOW d AS (PARTITION BY flow_imp_dt, tick_symb, opts_exp, opts_strk, opts_typ))""",
        """dated AS (SELECT *, strptime(opts_exp, '%m/%d/%Y')::DATE AS exp_day, strptime(flow_imp_dt, '%m/%d/%Y')::DATE AS f_day
                    FROM signals)""",
        f"""weeks AS (SELECT tick_symb, opts_exp, {weeks} AS wk,
                   dense_rank() OVER (PARTITION BY tick_symb ORDER BY {weeks}) AS wk_rank
            FROM (SELECT DISTINCT tick_symb, opts_exp, exp_date AS exp_day FROM clean))""",
        final=f"""SELECT DISTINCT CASE WHEN etf_flg = 'True' THEN 'ETFs' ELSE m.sector END AS sector, d.tick_symb,
          m.companyname AS tick_name, m.industry,
          strftime(try_strptime(replace(earnings, ' AMC', '') || ' 2001', '%b %d %Y'), '%m/%d/%Y') AS earnings_date,
          CASE WHEN price IS NULL THEN 0 ELSE {rst("price::DECIMAL(10,2)::DOUBLE - prevclose::DECIMAL(10,2)::DOUBLE", 2)} END AS price_chng,
          {half.format(i=1)} AS volatility_week, {half.format(i=2)} AS volatility_month,
          {", ".join(f"m.{s} AS {o}" for o, s in text.items())},
          {", ".join(f"m.{s}::DECIMAL(10,4)::DOUBLE / 100 AS {o}" for o, s in percent.items())},
          flow_imp_dt, d.opts_exp, opts_strk::DOUBLE AS opts_strk, opts_typ, etf_flg, bull_side, opts_oi::DOUBLE AS opts_oi,
          {_doubles(FLOW_SUMS[:6])}, opts_iv_imp_dt,
          CASE WHEN tot_vol_i = call_vol_i THEN 1 WHEN call_vol_i = 0 THEN 0
               ELSE {rst("(tot_vol_i - put_vol_i)::DOUBLE / nullif(tot_vol_i::DOUBLE, 0)", 4)} END::DOUBLE AS call_vol_i_perc,
          prev_oi::DOUBLE AS prev_oi, nextday_oi::DOUBLE AS nextday_oi, last_oi::DOUBLE AS last_oi, unusual_flg,
          CASE WHEN nextday_oi < opts_vol_imp_dt + opts_oi AND place = 1
               THEN opts_vol_imp_dt + opts_oi - nextday_oi ELSE 0 END::DOUBLE AS delta_chng_vol,
          {", ".join(f"round({c}, 0)::DOUBLE AS {c}" for c in sums)}, {", ".join(perc)},
          CASE dtls_side WHEN 'A' THEN 'Ask' WHEN 'B' THEN 'Bid' ELSE 'Mid' END AS dtls_side,
          upper(strftime(f_day, '%a')) AS flow_day, (dayofweek(f_day) + 1)::INT AS flow_day_nbr,
          wk::INT AS exp_wk_nbr, wk_rank::INT AS exp_wk_rownbr,
          CASE WHEN bull_side = 'Bullish' THEN opts_vol_side_imp_dt ELSE 0 END::DOUBLE AS bull_side_i_vol,
          CASE WHEN bull_side = 'Bullish' THEN opts_prem_side_imp_dt ELSE 0 END::DOUBLE AS bull_side_i_prem,
          CASE WHEN f_day = (SELECT max(flow_date) FROM clean WHERE tick_symb IN (SELECT symbol FROM summary))
               THEN 'Y' ELSE 'N' END AS ltstflowdt
          FROM dated d JOIN summary m ON m.symbol = d.tick_symb
          JOIN weeks w ON w.tick_symb = d.tick_symb AND w.opts_exp = d.opts_exp""",
    )


# --- calendar ------------------------------------------------------------

CALENDAR = """calendar AS (
  SELECT strftime(d, '%Y%m%d')::INT AS datedim_id, d AS actualdate, epoch(d)::BIGINT AS epoch,
         day(d) || CASE WHEN day(d) IN (11, 12, 13) THEN 'th' WHEN day(d) % 10 = 1 THEN 'st'
                        WHEN day(d) % 10 = 2 THEN 'nd' WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END AS daysuffix,
         dayname(d) AS dayname, isodow(d)::INT AS day_of_week, day(d)::INT AS day_of_month,
         (d - date_trunc('quarter', d)::DATE + 1)::INT AS day_of_quarter, dayofyear(d)::INT AS day_of_year,
         ((day(d) - 1) // 7 + 1)::INT AS week_of_month, weekofyear(d)::INT AS week_of_year,
         strftime(d, '%G-W%V-%u') AS week_of_year_iso, month(d)::INT AS month_actual, monthname(d) AS month_name,
         strftime(d, '%b') AS month_name_abbreviated, quarter(d)::INT AS quarter_actual,
         (['First', 'Second', 'Third', 'Fourth'])[quarter(d)] AS quarter_name, isoyear(d)::INT AS year_actual,
         d - (isodow(d) - 1)::INT AS first_day_of_week, d + (7 - isodow(d))::INT AS last_day_of_week,
         date_trunc('month', d)::DATE AS first_day_of_month, last_day(d) AS last_day_of_month,
         date_trunc('quarter', d)::DATE AS first_day_of_quarter,
         (date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE AS last_day_of_quarter,
         make_date(year(d), 1, 1) AS first_day_of_year, make_date(year(d), 12, 31) AS last_day_of_year,
         strftime(d, '%m%Y') AS mmyyyy, strftime(d, '%m%d%Y') AS mmddyyyy, isodow(d) >= 6 AS weekend_indr
  FROM (SELECT DISTINCT o_orderdate::DATE AS d FROM orders))"""

DATE_WINDOWS = with_(
    "spans AS (SELECT o_custkey, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1)",
    "sized AS (SELECT *, (b - a + 1) AS days, greatest(1, ceil((b - a + 1) / 70))::INT AS n FROM spans)",
    "split AS (SELECT *, unnest(range(n)) AS i FROM sized)",
    "placed AS (SELECT o_custkey, i, a, days // n AS base, days % n AS extra FROM split)",
    final="""SELECT o_custkey, i::INT AS window_no, a + (i * base + least(i, extra))::INT AS window_start,
      a + ((i + 1) * base + least(i + 1, extra) - 1)::INT AS window_end FROM placed""",
)

DAILY = """SELECT strftime(ts, '%Y%m%d') AS file_version_date, event_type, count(*)::BIGINT AS events,
  sum(user_id)::BIGINT AS users_sum FROM events GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "trade_cube": trade_cube(False),
    "trade_cube_staged": trade_cube(False),
    "trade_cube_strict": trade_cube(True),
    "cube_distinct": """SELECT l_suppkey, l_returnflag, l_linestatus, count(DISTINCT l_orderkey) AS orders,
        count(*) AS rows_seen FROM lineitem GROUP BY l_suppkey, CUBE (l_returnflag, l_linestatus)""",
    "cube_distinct_dense": """SELECT year(l_shipdate)::INT AS ship_year, l_returnflag, l_linestatus,
        count(DISTINCT l_orderkey) AS orders, count(*) AS rows_seen
        FROM lineitem GROUP BY year(l_shipdate), CUBE (l_returnflag, l_linestatus)""",
    "chain_base": with_(CONTRACTS, OI, BASE, final="SELECT * FROM base"),
    "option_trades_by_chain": with_(*CHAIN_CTES, final="SELECT * FROM chain_cube"),
    "strike_details": with_(*CHAIN_CTES, STRIKES, final="SELECT * FROM strikes"),
    "chain_analytics": with_(*CHAIN_CTES, STRIKES, ANALYTICS, final="SELECT * FROM analytics"),
    "chain_zscores": chain_zscores("a.*"),
    "chain_zscores_filtered": chain_zscores(
        "file_version_date, underlying_symbol, option_chain_id, option_type, strike, expiry",
        "expiry = 20020315",
    ),
    "contract_pivot": "SELECT l_partkey, "
    + ", ".join(f"sum(l_quantity) FILTER (l_returnflag = '{f}') AS qty_{f.lower()}" for f in "ARN")
    + ", "
    + ", ".join(f"max(l_extendedprice) FILTER (l_returnflag = '{f}') AS top_{f.lower()}" for f in "ARN")
    + ", CASE WHEN bool_or(l_linestatus = 'O') THEN 'Y' ELSE 'N' END AS any_open FROM lineitem GROUP BY l_partkey",
    "screener_metrics": with_(*SCREENER_CTES, final="SELECT * FROM metrics"),
    "sweep_premium_rollup": with_(CONTRACTS, TRADES, _sweeps(), final="SELECT * FROM sweeps"),
    "option_screener": with_(*SCREENER_CTES, _sweeps(), _option_screener(), final="SELECT * FROM screener"),
    "symbol_master": with_(MASTER, final="SELECT * FROM master"),
    "master_refresh": with_(MASTER, final="SELECT * FROM master"),
    "composite_score": composite_score(),
    "customer_percentiles": with_(
        "counts AS (SELECT o_custkey, count(*) AS orders FROM orders GROUP BY 1)",
        final=f"""SELECT c_custkey, c_mktsegment,
          {rs("percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal NULLS LAST)", 4)} AS balance_pct,
          {rs("percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY orders NULLS LAST)", 4)} AS orders_pct
          FROM customer LEFT JOIN counts ON o_custkey = c_custkey""",
    ),
    "customer_percentiles_present": with_(
        f"""counts AS (SELECT o_custkey, {rst("sum(o_totalprice) FILTER (o_orderstatus = 'F')", 2)} AS spent FROM orders
                       GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'F') > 0)""",
        f"""ranked AS (SELECT c_custkey AS k, {rs("percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY spent)", 4)} AS spent_pct
                       FROM customer JOIN counts ON o_custkey = c_custkey)""",
        final="SELECT c_custkey, c_mktsegment, spent_pct FROM customer LEFT JOIN ranked ON k = c_custkey",
    ),
    "golden_record": with_(
        """parties AS (
          SELECT c_nationkey AS nation, 1 AS priority, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS segment,
                 c_name AS name FROM customer
          UNION ALL SELECT s_nationkey, 2, NULL, s_name FROM supplier)""",
        """ranked AS (SELECT *, max(name) OVER (PARTITION BY nation) AS max_name,
             rank() OVER (PARTITION BY nation ORDER BY priority, segment NULLS LAST, name DESC NULLS LAST) AS place
           FROM parties)""",
        final="SELECT DISTINCT nation, priority, segment, name, max_name FROM ranked WHERE place = 1",
    ),
    "fundamentals_typed": with_(_fundamentals(), final="SELECT * FROM fundamentals"),
    "universe_screen": with_(
        _fundamentals(),
        final="""SELECT symbol, option_short, avgvolume, price FROM fundamentals
          WHERE option_short LIKE 'Yes%' AND avgvolume > 0.3::DOUBLE AND price > 2""",
    ),
    "ratings_typed": RATINGS,
    "ticker_universe": with_(
        CONTRACTS,
        TRADES,
        final="""SELECT DISTINCT sym AS ticker FROM trades
          WHERE day = (SELECT max(day) FROM trades) AND supp % 11 <> 0 AND supp % 9 <> 0""",
    ),
    "text_functions": """SELECT doc_id,
        md5(array_to_string(list_transform(string_split(lower(text), ' '),
            lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' ')) AS title_md5,
        md5(regexp_replace(text, 'e', '#')) AS first_md5, n_chars + 1 AS rounded_up,
        try_cast(split_part(text, ' ', 1) AS BIGINT) AS not_a_number FROM documents""",
    "analyst_scores": ANALYST,
    "earnings_calendar": EARNINGS,
    "technical_rank": TECHNICAL,
    "intraday_bars": with_(BARS, final="SELECT * FROM bar_rows"),
    "session_volume": with_(
        BARS,
        final="""SELECT "date"[:10] AS local_day, regular_trading, count(*) AS bars, sum(volume) AS volume,
          max(high) AS high FROM bar_rows GROUP BY ALL""",
    ),
    "flow_prints_clean": with_(
        CONTRACTS,
        PRINTS,
        final=f"""SELECT tick_symb, exec_tm, opts_exp, opts_typ, NULL::VARCHAR AS er_date, etf_flg,
          printf('%.2f', iv::DOUBLE) AS opts_iv, flow_imp_dt, tick_indstry, trans_typ, dtls_side, bull_side, moneyness,
          {_doubles(["opts_strk", "opts_oi", "opts_price", "opts_vol", "tick_spot"])} FROM clean""",
    ),
    "flow_contract_stats": with_(
        CONTRACTS,
        PRINTS,
        _contract_stats(),
        final=f"""SELECT * REPLACE ({_doubles([*FLOW_SUMS, "call_vol_i", "put_vol_i", "tot_vol_i"])})
          FROM contract_stats""",
    ),
    "open_interest_history": with_(
        CONTRACTS,
        PRINTS,
        HISTORY,
        final=f"""SELECT flow_imp_dt, tick_symb, opts_exp, opts_typ,
          (opts_oi - prev_oi)::DOUBLE AS delta_oi,
          {rst("(opts_oi - prev_oi)::DOUBLE / nullif(opts_oi, 0)::DOUBLE * 100", 2)} AS delta_oi_perc,
          {_doubles(["opts_strk", "opts_oi", "prev_oi", "nextday_oi", "last_oi", "tot_vol"])} FROM history""",
    ),
    "daily_ticker_summary": with_(_attribute_rows("customer", "c_custkey", "C"), final="SELECT * FROM summary"),
    "flow_stats": flow_stats(),
    "order_neighbours": with_(
        """daily AS (SELECT o_custkey, o_orderdate::DATE AS day, sum(floor(o_totalprice))::BIGINT AS value
                     FROM orders GROUP BY ALL)""",
        final="""SELECT o_custkey, day, value, lag(value) OVER w AS prev, lead(value) OVER w AS next,
          last_value(value) OVER (PARTITION BY o_custkey ORDER BY day
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last
          FROM daily WINDOW w AS (PARTITION BY o_custkey ORDER BY day)""",
    ),
    "return_shares": "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, "
    + ", ".join(
        "coalesce("
        + rs(f"sum(l_quantity) FILTER (l_returnflag = '{f}') OVER w / nullif(sum(l_quantity) OVER w, 0)", 4)
        + f", 0) AS share_{f.lower()}"
        for f in "ARN"
    )
    + " FROM lineitem WINDOW w AS (PARTITION BY l_suppkey)",
    "order_zscores": f"""SELECT o_orderkey, o_orderpriority, {_z("o_totalprice", "w")} AS price_z
        FROM orders WINDOW w AS (PARTITION BY o_orderpriority)""",
    "attribute_values_pivot": "SELECT user_id, "
    + ", ".join(
        f"max(value) FILTER (event_type = '{t}') AS {t}" for t in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM events GROUP BY user_id",
    "calendar_of_orders": with_(CALENDAR, final="SELECT * FROM calendar"),
    "calendar_lookup": """SELECT o_orderpriority, week_close,
        dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY week_close)::INT AS week_rank
        FROM (SELECT DISTINCT o_orderpriority,
                     o_orderdate::DATE + (7 - isodow(o_orderdate))::INT AS week_close FROM orders)""",
    "customer_date_windows": DATE_WINDOWS,
    "newest_orders": """SELECT o_orderkey, o_custkey FROM orders
        WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    "newest_flag": """SELECT CASE WHEN o_orderdate = (SELECT max(o_orderdate) FROM orders) THEN 'Y' ELSE 'N' END AS newest,
        count(*) AS orders FROM orders GROUP BY 1""",
    "pending_dates": """SELECT strftime(l_shipdate, '%Y%m%d') AS file_version_date FROM lineitem
        EXCEPT SELECT strftime(o_orderdate, '%Y%m%d') FROM orders""",
    "part_sets": """SELECT *, 'A and R' AS found FROM (
          SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'
          INTERSECT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R')
        UNION ALL SELECT *, 'N not A' FROM (
          SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'
          EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')""",
    "party_stack": """SELECT nation, c_mktsegment, count(*) AS parties, max(balance) AS best, min(balance) AS worst
        FROM (SELECT c_nationkey AS nation, c_mktsegment, c_acctbal AS balance FROM customer
              UNION ALL SELECT s_nationkey, NULL, s_acctbal FROM supplier) GROUP BY ALL""",
    "full_outer_parties": with_(
        "c AS (SELECT floor(c_acctbal / 50)::BIGINT AS b, count(*) AS customers FROM customer GROUP BY 1)",
        "s AS (SELECT floor(s_acctbal / 50)::BIGINT AS b, count(*) AS suppliers FROM supplier GROUP BY 1)",
        final="SELECT coalesce(c.b, s.b) AS band, customers, suppliers FROM c FULL JOIN s ON c.b = s.b",
    ),
    "liquid_parts": """SELECT l_partkey, sum(l_quantity) AS tot_cnt, max(l_extendedprice) AS top_price
        FROM lineitem GROUP BY l_partkey HAVING tot_cnt >= 900 OR top_price >= 100000""",
    "incremental_rerun": DAILY,
    "stream_ingest": DAILY,
    "csv_ingest": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, count(*) AS rows_read, 0::BIGINT AS first_id,
        true AS dense, sum(event_id)::BIGINT AS ids, max(length(props))::INT AS longest_props FROM events GROUP BY 1""",
    "csv_layout_drift": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, count(*) AS rows_read,
        sum(event_id)::BIGINT AS ids, sum(user_id)::BIGINT AS users,
        count(*) FILTER (day(ts) % 2 = 1) AS typed, count(*) AS row_ids FROM events GROUP BY 1""",
    "csv_stage_renamed": """SELECT event_id::VARCHAR AS event_id, CASE WHEN event_id % 3 <> 0 THEN event_type ELSE '' END
        AS event_type, strftime(ts, '%Y%m%d') AS file_version_date FROM events""",
    "json_stage": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, count(*) AS rows_read,
        sum(event_id)::BIGINT AS ids, count(*) - 1 AS last_number, count(*) AS numbers, 0 AS absent_length
        FROM events GROUP BY 1""",
    "earnings_feed": EARNINGS,
    "rank_feed": """WITH chosen AS (
          SELECT *, event_id % 4 AS kind, strftime(ts, '%Y-%m-%d') AS d FROM events
          WHERE event_id % 4 = day(ts) % 4 OR day(ts) % 3 = 0)
        SELECT coalesce(CASE WHEN kind <> 1 THEN d END,
            min(CASE WHEN kind <> 1 THEN d END) OVER (PARTITION BY d)) AS "date", 'U' || user_id AS symbol,
          NULL::VARCHAR AS "marketCap", event_id::VARCHAR AS vol, event_type AS name, NULL::VARCHAR AS "SCTR",
          NULL::VARCHAR AS delta, NULL::VARCHAR AS industry, NULL::VARCHAR AS sector, NULL::VARCHAR AS close,
          CASE kind WHEN 0 THEN 'large' WHEN 1 THEN 'mid' WHEN 2 THEN 'small' ELSE 'etf' END AS marketcaptype,
          strftime(ts, '%Y%m%d') AS file_version_date FROM chosen""",
    "late_and_corrected_files": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, count(*) AS rows_read,
        sum(event_id)::BIGINT AS ids, 0 AS taken_again FROM events
        WHERE event_id % 2 = 1 OR day(ts) % 2 = 1 OR user_id % 3 = 0 GROUP BY 1""",
    "bars_feed": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, count(*) AS bars,
        sum(event_id)::DOUBLE AS open, sum(event_id + 4)::DOUBLE AS volume FROM events GROUP BY 1""",
    "rerun_to_empty": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, event_type, count(*) AS events,
        sum(user_id)::BIGINT AS users_sum FROM events
        WHERE ts::DATE < (SELECT max(ts)::DATE FROM events) GROUP BY 1, 2""",
    "empty_date_once": """SELECT run::INT AS run, (CASE run WHEN 1 THEN n ELSE 0 END)::INT AS dates, n - 1 AS staged_dates
        FROM range(1, 4) r(run), (SELECT count(DISTINCT ts::DATE) AS n FROM events)""",
    "stream_two_files_one_date": """SELECT strftime(ts, '%Y%m%d') AS file_version_date, event_type,
        count(*) AS events, sum(user_id)::BIGINT AS users_sum FROM events GROUP BY 1, 2""",
    "append_gzip": """SELECT c_name AS name, c_nationkey AS nation, 'c' AS source FROM customer
        UNION ALL SELECT s_name, s_nationkey, 's' FROM supplier""",
    "quarter_days": """SELECT d::DATE AS day, count(o_orderkey) AS orders
        FROM (SELECT unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS d FROM orders)
        LEFT JOIN orders ON o_orderdate::DATE = d::DATE GROUP BY 1""",
}

# Kept by day or computed at once, the results are the same.
ORACLE["flow_stats_incremental"] = ORACLE["flow_contract_stats"]
ORACLE["open_interest_incremental"] = ORACLE["open_interest_history"]
ORACLE["chain_zscores_bucketed"] = ORACLE["chain_zscores"]
ORACLE["fundamentals_from_csv"] = ORACLE["fundamentals_typed"]
ORACLE["flow_prints_after_close"] = ORACLE["flow_prints_clean"].replace(KEPT, KEPT_AFTER_CLOSE)
