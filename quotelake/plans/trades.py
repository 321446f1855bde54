"""Option-trade cubes and chain / strike analytics."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions import (
    compact_date_int,
    replace_all_text,
    round_scaled,
    safe_ratio,
    strict_bigint,
    strict_double,
    try_bigint,
    try_double,
)
from quotelake.operators import (
    WeightedAverage,
    conditional_pivot,
    count_rows,
    cube_agg,
    cube_leaves,
    cube_of_leaves,
    highest,
    keep_matching,
    lowest,
    total,
    zscore,
)
from quotelake.operators.cube import Measure
from quotelake.session import partitions_for

# Condition codes of the feed, class labels, the liquidity
# threshold, and the greeks with the digits they are rounded to.
AUTO_MULTILEG_CODES = ["mlet", "mlat", "mlct", "tlct", "tlft", "tlet", "tlat"]
SWEEP_CODES = ["slan", "slai", "mesl", "slcn", "slft", "mfsl"]
MANUAL_MULTILEG_CODES = ["isoi", "mlft"]
MIN_CHAIN_SIZE = 100
# Order of rows in the files of the staged cube; NULLs last.
STAGE_ORDER = ["underlying_symbol", "option_chain_id", "expiry", "strike", "option_tx_type", "side"]
TOTAL = "total"
AVERAGES = [
    ("wtd_avg_price", "price", 2),
    ("wtd_avg_iv", "implied_volatility", 4),
    ("wtd_avg_delta", "delta", 4),
    ("wtd_avg_gamma", "gamma", 4),
    ("wtd_avg_vega", "vega", 4),
    ("wtd_avg_theta", "theta", 4),
    ("wtd_avg_rho", "rho", 4),
    ("wtd_avg_theo", "theo", 4),
]

DAY = "file_version_date"
CHAIN = "option_chain_id"
CHAIN_DAY = [DAY, CHAIN]
CONTRACT = [DAY, "underlying_symbol", CHAIN, "option_type", "strike", "expiry"]


def transaction_type(code: Column | str, split_multileg: bool = True) -> Column:
    """Class of a trade by its condition code (four classes, or three)."""
    code = F.col(code) if isinstance(code, str) else code
    auto, manual = ("auto_multileg", "manual_multileg") if split_multileg else ("multileg", "multileg")
    return (
        F.when(code.isin(AUTO_MULTILEG_CODES), auto)
        .when(code.isin(SWEEP_CODES), "sweep")
        .when(code.isin(MANUAL_MULTILEG_CODES), manual)
        .otherwise("standard")
    )


def direction(option_type: Column, side: Column) -> Column:
    """'bull', 'bear' or 'neutral'; NULL when the side says nothing."""
    call, put = option_type == "call", option_type == "put"
    ask, bid = side == "ask", side == "bid"
    return (
        F.when((call & ask) | (put & bid), "bull")
        .when((call & bid) | (put & ask), "bear")
        .when(side == "mid", "neutral")
    )


def _typed_trades(trades: DataFrame, split_multileg: bool, expiry: Column) -> DataFrame:
    """The columns the cubes need, typed. Bad size, premium or price fails the job."""
    return trades.select(
        DAY,
        "underlying_symbol",
        CHAIN,
        "option_type",
        round_scaled(try_double("strike"), 2).alias("strike"),
        expiry.alias("expiry"),
        "side",
        transaction_type("upstream_condition_detail", split_multileg).alias("option_tx_type"),
        strict_bigint("size").alias("size"),
        strict_bigint("premium").alias("premium"),
        strict_bigint("open_interest").alias("open_interest"),
        strict_double("price").alias("price"),
        *[try_double(source).alias(source) for _, source, _ in AVERAGES[1:]],
    )


CUBE_COLS = ["side", "option_tx_type"]
# Trades whose leaves and grouping sets one task holds, in about a GB.
TRADES_PER_TASK = 400_000
# The same for a bucket of stage tables, whose scan also holds the analytics of its contracts.
TRADES_PER_BUCKET = 200_000


def _measures() -> list[Measure]:
    return [
        count_rows("trade_count"),
        total("total_contracts", F.col("size")),
        total("total_premium", F.col("premium")),
        highest("open_interest", F.col("open_interest")),
        lowest("min_price", F.col("price")),
        highest("max_price", F.col("price")),
    ]


def _averages() -> list[WeightedAverage]:
    return [
        WeightedAverage(name, F.col(source), F.col("size"), "total_contracts", digits) for name, source, digits in AVERAGES
    ]


def _cube(typed: DataFrame, on_leaves: Callable[[DataFrame], DataFrame], strict: bool) -> DataFrame:
    """CUBE(side, transaction type) per contract, with subtotals labelled.

    A chain is one contract, so its trades of a day are bounded. The typed
    trades are placed by (day, chain) once, and leaves, filter, cube and later
    pivots share that layout. Trades without day or chain are in no cube.
    """
    cubed = cube_agg(
        typed.where(F.col(DAY).isNotNull() & F.col(CHAIN).isNotNull()),
        CONTRACT,
        CUBE_COLS,
        _measures(),
        _averages(),
        on_leaves=on_leaves,
        distribute_by=CHAIN_DAY,
        partitions=partitions_for(typed, TRADES_PER_TASK),
        grouping_col="__gid",
    )
    return _label_subtotals(cubed, strict)


def _label_subtotals(cubed: DataFrame, strict: bool) -> DataFrame:
    """As in the feed's established tables, 'total' also labels the rows whose
    side is NULL; ``strict`` keeps the label for real subtotals.
    """
    side_subtotal = F.col("__gid").bitwiseAND(2) > 0
    if strict:
        label = F.when(side_subtotal, TOTAL).otherwise(F.coalesce("side", F.lit("unknown")))
    else:
        label = F.coalesce("side", F.lit(TOTAL))
    return cubed.withColumn("side", label)


def option_trade_cube(trades: DataFrame, min_size: int = MIN_CHAIN_SIZE, strict: bool = False) -> DataFrame:
    """Per liquid chain and day: counts, sums and weighted averages by side and type.

    A chain is kept when its day's contracts, or its open interest, reach
    ``min_size``. Both are totals of the reduced leaves, so the trades are read
    once.
    """

    def liquid(leaves: DataFrame) -> DataFrame:
        chain = Window.partitionBy(*CHAIN_DAY)
        size = F.sum("total_contracts").over(chain)
        interest = F.max("open_interest").over(chain)
        liquid = leaves.withColumn("__liquid", (size >= min_size) | (interest >= min_size))
        return liquid.where("__liquid").drop("__liquid")

    return _cube(_typed_trades(trades, True, F.col("expiry")), liquid, strict).drop("__gid")


def chain_base(
    oi_changes: DataFrame,
    symbols: Sequence[str] | None = None,
    expiries: Sequence[int] | None = None,
) -> DataFrame:
    """Distinct open-interest changes with the contract symbol decoded."""
    symbol_length = F.length("underlying_symbol")
    volume, before = try_bigint("curr_vol"), try_bigint("prev_vol")
    interest = try_bigint(replace_all_text("curr_oi", ","))
    code = F.col("option_symbol")
    date_part = F.concat(F.lit("20"), F.substr(code, symbol_length + 1, F.lit(6)))
    rows = oi_changes if symbols is None else oi_changes.where(F.col("underlying_symbol").isin(list(symbols)))
    base = rows.select(
        DAY,
        "option_symbol",
        "underlying_symbol",
        try_double("strike").alias("strike"),
        try_bigint(date_part).try_cast("int").alias("expiry"),
        F.substr(code, symbol_length + 7, F.lit(1)).alias("option_typ"),
        try_bigint("dte").try_cast("int").alias("days_to_expiry"),
        volume.alias("curr_chain_vol"),
        before.alias("prev_chain_vol"),
        (volume - before).alias("chain_vol_diff"),
        interest.alias("curr_oi"),
        try_bigint(replace_all_text("last_oi", ",")).alias("prev_oi"),
        try_bigint("oi_diff_plain").alias("oi_diff"),
        safe_ratio(volume, interest, 2).alias("unusual_curr_vol"),
        safe_ratio(volume - before, interest, 2).alias("unusual_diff_vol"),
    )
    if expiries is not None:
        base = base.where(F.col("expiry").isin(list(expiries)))
    return base.distinct()


def option_trades_by_chain(trades: DataFrame, base: DataFrame, strict: bool = False) -> DataFrame:
    """The cube (three classes) over the chains of ``base``, with a direction.

    Trades are reduced before the chains are looked up: the semi-join keys are
    grouping keys, so the order does not matter to the result.
    """
    chains = base.select(DAY, F.col("option_symbol").alias(CHAIN))
    cubed = _cube(
        _typed_trades(trades, False, compact_date_int("expiry")),
        lambda leaves: keep_matching(leaves, chains, CHAIN_DAY),
        strict,
    )
    return _with_direction(cubed, strict)


def _with_direction(cubed: DataFrame, strict: bool) -> DataFrame:
    leaf = F.coalesce(direction(F.col("option_type"), F.col("side")), F.lit("other" if strict else TOTAL))
    flag = F.when(F.col("side") == TOTAL, TOTAL).otherwise(leaf)
    return cubed.withColumn("bull_bear_flg", flag).drop("__gid")


# Key of the stage tables below: day and chain in one column, the one they are bucketed by.
CHAIN_KEY = "chain_day"


def _chain_key(chain: str) -> Column:
    return F.concat(DAY, F.lit(" "), chain).alias(CHAIN_KEY)


def chain_leaves(trades: DataFrame) -> DataFrame:
    """The trades of ``option_trades_by_chain`` reduced to leaves, with the key of their chain and day."""
    typed = _typed_trades(trades, False, compact_date_int("expiry"))
    leaves = cube_leaves(typed, CONTRACT, CUBE_COLS, _measures(), _averages())
    return leaves.select(_chain_key(CHAIN), *leaves.columns)


def keyed_chain_base(oi_changes: DataFrame) -> DataFrame:
    """``chain_base`` with the same key."""
    base = chain_base(oi_changes)
    return base.select(_chain_key("option_symbol"), *base.columns)


def option_trades_of_leaves(leaves: DataFrame, base: DataFrame, strict: bool = False) -> DataFrame:
    """``option_trades_by_chain`` from stage tables; where both are bucketed by the key nothing is shuffled."""
    kept = keep_matching(leaves, base, [CHAIN_KEY])
    cubed = cube_of_leaves(kept, [CHAIN_KEY, *CONTRACT], CUBE_COLS, _measures(), _averages(), "__gid")
    return _with_direction(_label_subtotals(cubed, strict), strict)


# Output prefix -> (direction, transaction type) of the strike totals.
STRIKE_GROUPS = {
    "total": ("total", None),
    "bull": ("bull", None),
    "bear": ("bear", None),
    "sweep": ("total", "sweep"),
    "bull_sweep": ("bull", "sweep"),
    "bear_sweep": ("bear", "sweep"),
    "ml": ("total", "multileg"),
}
# Output suffix -> measure of the cube.
STRIKE_MEASURES = {"trades": "trade_count", "vol": "total_contracts", "prem": "total_premium"}
STRIKE_COLUMNS = [f"{group}_strike_{suffix}" for group in STRIKE_GROUPS for suffix in STRIKE_MEASURES]
# Expiry before strike: the strikes of an expiry then share its sort order.
STRIKE = [DAY, "underlying_symbol", "expiry", "strike"]


def _type_is(name: str | None) -> Column:
    kind = F.col("option_tx_type")
    return kind.isNull() if name is None else kind == name


def _strike_spec() -> dict:
    groups = {name: (F.col("bull_bear_flg") == flag) & _type_is(kind) for name, (flag, kind) in STRIKE_GROUPS.items()}
    return {
        f"{group}_strike_{suffix}": (F.sum, rows, measure)
        for group, rows in groups.items()
        for suffix, measure in STRIKE_MEASURES.items()
    }


def strike_details(cube: DataFrame) -> DataFrame:
    """Trades, volume and premium per strike by direction and type (21 sums)."""
    return conditional_pivot(cube, STRIKE, _strike_spec())


# Measure of the cube -> transaction type -> columns for total, ask and bid.
CONTRACT_COLUMNS = {
    "trade_count": {None: ("total_trades", "trades_at_ask", "trades_at_bid")},
    "total_contracts": {
        None: ("total_vol", "ask_vol", "bid_vol"),
        "sweep": ("total_sweep_vol", "sweep_ask_vol", "sweep_bid_vol"),
        "multileg": ("total_ml_vol", "ml_ask_vol", "ml_bid_vol"),
    },
    "total_premium": {
        None: ("total_premium", "total_premium_at_ask", "total_premium_at_bid"),
        "sweep": ("total_sweep_premium", "sweep_ask_premium", "sweep_bid_premium"),
        "multileg": ("total_ml_premium", "ml_ask_premium", "ml_bid_premium"),
    },
}
# Column of the total row -> measure of the cube.
TOTAL_COLUMNS = {
    "min_price": "min_price",
    "max_price": "max_price",
    "total_avg_price": "wtd_avg_price",
    "total_avg_delta": "wtd_avg_delta",
    "total_avg_gamma": "wtd_avg_gamma",
}


def _contract_spec() -> dict:
    kinds = {kind: _type_is(kind) for kind in (None, "sweep", "multileg")}
    groups = {(s, k): (F.col("side") == s) & is_kind for k, is_kind in kinds.items() for s in ("total", "ask", "bid")}
    spec = {}
    for measure, by_kind in CONTRACT_COLUMNS.items():
        for kind, names in by_kind.items():
            for side, name in zip(("total", "ask", "bid"), names):
                spec[name] = (F.max, groups[side, kind], measure)
    for name, measure in TOTAL_COLUMNS.items():
        spec[name] = (F.max, groups["total", None], measure)
    return spec


BASE_COLUMNS = [
    "days_to_expiry",
    "curr_chain_vol",
    "prev_chain_vol",
    "chain_vol_diff",
    "curr_oi",
    "prev_oi",
    "oi_diff",
    "unusual_diff_vol",
    "unusual_curr_vol",
]


# Contracts whose rows one task sorts for the windows over an expiry, in about 100 MB.
CONTRACTS_PER_TASK = 100_000


def chain_analytics(
    cube: DataFrame, base: DataFrame, key: str | None = None, partitions: int | None = None
) -> DataFrame:
    """One row per contract: open interest, cube pivot and its strike's totals.

    The contract pivot and the strike sums come from the same aggregation; a
    strike's totals are then window sums over its few contracts, so the cube is
    neither read again nor joined to its own derivatives. ``key`` names the
    column that stands for day and chain where both frames have one, and
    ``partitions`` bounds what a task of those windows sorts: run-time coalescing
    goes by compressed bytes, and the session's number need not grow with the rows.
    """
    chain = [key] if key else CHAIN_DAY
    base_chain = [key] if key else [DAY, F.col("option_symbol").alias(CHAIN)]
    pivot = _contract_spec()
    contracts = conditional_pivot(
        cube.where(F.col("strike").isNotNull() & F.col("expiry").isNotNull() & F.col("underlying_symbol").isNotNull()),
        [*CONTRACT, key] if key else CONTRACT,
        {**pivot, **_strike_spec()},
    )
    # NULL is not unusual; a flag of numbers, since text has no hash aggregate.
    unusual = F.coalesce((F.col("unusual_diff_vol") > 1) | (F.col("unusual_curr_vol") > 2), F.lit(False))
    facts = base.groupBy(*base_chain).agg(
        *[F.max(c).alias(c) for c in BASE_COLUMNS], F.when(F.bool_or(unusual), "Y").otherwise("N").alias("unusual_vol_flg")
    )
    per_strike = Window.partitionBy(*STRIKE)
    joined = (
        contracts.join(facts, chain)
        .repartition(*([partitions] if partitions else []), DAY, "underlying_symbol", "expiry")
        .withColumns({c: F.sum(c).over(per_strike) for c in STRIKE_COLUMNS})
        .withColumn("net_strike_prem", F.col("bull_strike_prem") - F.col("bear_strike_prem"))
    )
    bear = STRIKE_COLUMNS.index("bear_strike_prem") + 1
    return joined.select(
        *CONTRACT,
        *BASE_COLUMNS,
        "unusual_vol_flg",
        *pivot,
        *STRIKE_COLUMNS[:bear],
        "net_strike_prem",
        *STRIKE_COLUMNS[bear:],
    )


# Output -> input of the z-scores among the contracts of an expiry and type,
# and among the strikes of an expiry.
CONTRACT_ZSCORES = {
    "chain_vol_diff_zscore": "chain_vol_diff",
    "chain_oi_diff_zscore": "oi_diff",
    "chain_trades_zscore": "total_trades",
    "chain_sweep_vol_zscore": "total_sweep_vol",
    "chain_prem_zscore": "total_premium",
    "chain_sweep_prem_zscore": "total_sweep_premium",
}
STRIKE_ZSCORES = {
    f"{name}_zscore": name
    for name in [
        "total_strike_prem",
        "sweep_strike_vol",
        "sweep_strike_prem",
        "bull_strike_trades",
        "bull_strike_vol",
        "bull_strike_prem",
        "net_strike_prem",
    ]
}


def chain_zscores(analytics: DataFrame) -> DataFrame:
    """Add z-scores per (day, symbol, type, expiry) and per (day, symbol, expiry).

    Strike metrics count once per strike although several contracts carry them.
    The groups are the contracts listed for one expiry, a bounded number, and
    every window here is served by the layout ``chain_analytics`` left.
    """
    expiry = [DAY, "underlying_symbol", "expiry"]
    one_per_strike = F.row_number().over(Window.partitionBy(*STRIKE).orderBy(CHAIN)) == 1
    rows = analytics.where(F.col("option_type").isNotNull()).withColumn("__first", one_per_strike)
    rows = zscore(rows, STRIKE_ZSCORES, expiry, small_groups=True, sample=F.col("__first"))
    rows = zscore(rows, CONTRACT_ZSCORES, [DAY, "underlying_symbol", "option_type", "expiry"], small_groups=True)
    return rows.select(*analytics.columns, *CONTRACT_ZSCORES, *STRIKE_ZSCORES)
