"""Regime features of a macro table: one row each business day, one column each series, so its windows have no partition.

A group of columns comes out only if its inputs are there. Features of the series come first, then what combines them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.windows import change, clip, ffill, flag, mean_of, most, roll, zscore

YEAR = 252

# Names of series and features, and rows looked back.
#: Feature: the series that it takes the difference of.
SPREADS = {
    "yc_slope_10y2y": ("treasury_10y", "treasury_2y"),
    "yc_slope_10y3m": ("treasury_10y", "treasury_3m"),
    "yc_slope_30y2y": ("treasury_30y", "treasury_2y"),
    "term_premium_proxy": ("treasury_30y", "treasury_5y"),
    "infl_expect_gap": ("inflation_expectations", "breakeven_inflation_10y"),
    "brent_wti_spread": ("oil_brent", "oil_wti"),
    "mortgage_spread": ("mortgage_30y", "treasury_10y"),
}
#: Feature: series and rows of an absolute change.
CHANGES = {
    **{f"rate_{t}_{k}d_chg": (c, k) for t, c in (("10y", "treasury_10y"), ("2y", "treasury_2y"), ("ff", "fed_funds_rate")) for k in (5, 20, 60)},
    **{f"{t}_{k}d_chg": (c, k) for t, c in (("yc_slope", "yc_slope_10y2y"), ("real_yield", "real_yield_10y"), ("breakeven", "breakeven_inflation_10y"), ("vix", "vix"), ("mortgage", "mortgage_30y")) for k in (5, 20)},
    **{f"{c}_{k}d_chg": (c, k) for c in ("hy_spread", "bbb_spread", "ted_spread") for k in (5, 20)},
    "infl_expect_5d_chg": ("inflation_expectations", 5),
    "nfci_5d_chg": ("nfci", 5),
    "stress_5d_chg": ("stress_index", 5),
    "sentiment_mom": ("consumer_sentiment", 22),
    "unemp_3m_chg": ("unemployment_rate", 63),
}
#: Feature: series and rows of a relative change.
RETURNS = {
    **{f"{t}_{k}d_ret": (c, k) for t, c in (("usd", "usd_index_broad"), ("eur", "usd_eur"), ("jpy", "jpy_usd"), ("gbp", "usd_gbp"), ("gold", "gold_price"), ("copper", "copper_price")) for k in (5, 20)},
    **{f"{t}_{k}d_ret": (c, k) for t, c in (("oil", "oil_wti"), ("btc", "btc_price")) for k in (5, 20, 60)},
    "gas_5d_ret": ("gas_price", 5),
    "vix_5d_pct": ("vix", 5),
    "cpi_mom": ("cpi", 22),
    "core_cpi_mom": ("core_cpi", 22),
    "claims_4w_chg": ("claims_4w_ma", 20),
    "continued_claims_mom": ("continued_claims", 20),
    "payrolls_mom": ("nonfarm_payrolls", 22),
    "housing_starts_mom": ("housing_starts", 22),
    "permits_mom": ("building_permits", 22),
    "m2_yoy_growth": ("m2_money_supply", 252),
    "m2_3m_growth": ("m2_money_supply", 63),
    "fed_bs_yoy_growth": ("fed_balance_sheet", 252),
    "leading_index_mom": ("leading_index", 22),
    "ip_mom": ("industrial_production", 22),
    "retail_sales_mom": ("retail_sales_ex_food", 22),
    "durables_mom": ("durable_goods_orders", 22),
    "copper_gold_momentum": ("copper_gold_ratio", 20),
}
#: Feature: series of a score against its last year.
SCORES = {
    "yc_slope_10y2y_z": "yc_slope_10y2y",
    "real_yield_z": "real_yield_10y",
    "vix_z": "vix",
    "hy_spread_z": "hy_spread",
    "bbb_spread_z": "bbb_spread",
    "ted_spread_z": "ted_spread",
    "claims_z": "initial_claims",
    "sentiment_z": "consumer_sentiment",
    "usd_z": "usd_index_broad",
    "oil_z": "oil_wti",
    "gold_z": "gold_price",
    "inv_sales_z": "inventory_sales_ratio",
    "btc_z": "btc_price",
    "copper_z": "copper_price",
    "copper_gold_ratio_z": "copper_gold_ratio",
}
#: Flag: column, side and bound.
FLAGS = {
    "yc_inverted_10y2y": ("yc_slope_10y2y", "<", 0.0),
    "yc_inverted_10y3m": ("yc_slope_10y3m", "<", 0.0),
    "yc_flattening": ("yc_slope_5d_chg", "<", 0.0),
    "credit_stress": ("credit_risk_composite", ">", 1.0),
    "claims_rising": ("claims_4w_chg", ">", 0.05),
    "sahm_recession_flag": ("sahm_rule_indicator", ">=", 0.5),
    "usd_strong": ("usd_z", ">", 1.0),
    "fed_bs_tightening": ("fed_bs_yoy_growth", "<", 0.0),
    "nfci_tightening": ("nfci", ">", 0.0),
    "stress_elevated": ("stress_index", ">", 0.0),
    "leading_index_negative": ("leading_index_mom", "<", 0.0),
    "risk_on_regime": ("risk_appetite_composite", ">", 0.5),
    "risk_off_regime": ("risk_appetite_composite", "<", -0.5),
    "btc_risk_signal": ("btc_5d_ret", ">", 0.0),
    "flow_risk_on": ("aggregate_flow_signal", ">", 0.5),
}
#: Composite: its members, a minus sign for those that count against it. Members that are missing are left out.
COMPOSITES = {
    "credit_risk_composite": ["hy_spread_z", "bbb_spread_z", "ted_spread_z"],
    "risk_appetite_composite": ["-vix_z", "-credit_risk_composite", "yc_slope_10y2y_z", "-usd_z"],
    "policy_tightness": ["rate_ff_20d_chg", "-fed_bs_yoy_growth", "real_yield_z"],
    "risk_appetite_v2": ["btc_z", "copper_gold_ratio_z", "aggregate_flow_signal"],
}
GROWTH = ["ip_mom", "payrolls_mom", "retail_sales_mom"]
INFLATION = ["cpi_mom", "core_cpi_mom", "breakeven_5d_chg"]
#: Upper bounds of the regimes of volatility; a level at 0, over the last or unknown is 'nan'.
REGIMES = [(15, "low"), (20, "normal"), (25, "elevated"), (35, "high"), (100, "crisis")]
#: Feature: flow column that it repeats.
FLOW_NAMES = {"spy_flow_5d": "spy_flow_momentum", "credit_flow_signal": "hyg_abnormal_volume", "safety_flow_signal": "tlt_abnormal_volume"}


def macro_table(raw: DataFrame, cross: DataFrame | None = None, flows: DataFrame | None = None) -> DataFrame:
    """Features of the economic series with cross-asset closes and fund flows joined on their dates."""
    for more in (cross, flows):
        raw = raw if more is None else raw.join(more, "date", "left")
    return macro_features(raw)


def _regime(level: Column) -> Column:
    out = F.when(level <= 0, "nan")
    for top, name in REGIMES:
        out = out.when(level <= top, name)
    return out.otherwise("nan")


def _composite(members: Iterable[str], have: set[str]) -> Column | None:
    """Mean of the known members that the table has, NULL where none is known."""
    parts = [-F.col(m[1:]) if m.startswith("-") else F.col(m) for m in members if m.lstrip("-") in have]
    return mean_of(*parts) if parts else None


def macro_features(df: DataFrame) -> DataFrame:
    """All columns of `df` and the features whose inputs are there. A missing value makes a flag 0 and a number NULL;
    relative changes carry the last known value forward."""
    days = Window.orderBy("date")
    have = set(df.columns)

    def add(found: dict[str, Column | None], *needs: str) -> None:
        nonlocal df
        found = {n: c for n, c in found.items() if c is not None}
        if found and set(needs) <= have:
            df = df.withColumns(found)
            have.update(found)

    add({n: F.col(a) - F.col(b) for n, (a, b) in SPREADS.items() if {a, b} <= have})
    add({"yc_curvature": F.expr("treasury_2y - (treasury_10y + treasury_1y) / 2")}, "treasury_1y", "treasury_2y", "treasury_10y")
    add({"gold_oil_ratio": F.col("gold_price") / clip("oil_wti", 0.01)}, "gold_price", "oil_wti")
    add({"copper_gold_ratio": F.col("copper_price") / clip("gold_price", 0.01)}, "copper_price", "gold_price")
    add({"claims_4w_ma": roll(F.avg, "initial_claims", days, 20, 5)}, "initial_claims")
    add({"vix_ma20": roll(F.avg, "vix", days, 20, 5), "vix_regime": _regime(F.col("vix"))}, "vix")
    low_rise = roll(F.avg, "unemployment_rate", days, 63, 22) - roll(F.min, "unemployment_rate", days, YEAR, 63)
    add({"sahm_rule_indicator": most(low_rise, F.lit(0.0))}, "unemployment_rate")

    padded = {f"__{c}": ffill(c, days) for c in sorted({c for c, _ in RETURNS.values()} & have)}
    add(padded)
    add(
        {n: F.col(c) - F.lag(c, k).over(days) for n, (c, k) in CHANGES.items() if c in have}
        | {n: change(f"__{c}", F.lag(f"__{c}", k).over(days)) for n, (c, k) in RETURNS.items() if c in have}
        | {n: zscore(c, days, YEAR) for n, c in SCORES.items() if c in have}
    )
    df = df.drop(*padded)
    add({"vix_above_ma20": flag(F.col("vix") > F.col("vix_ma20") * (1 + 1e-12)), "vix_term_structure": F.col("vix") / clip("vix_ma20", 1.0)}, "vix_ma20")
    quarter = lambda c, q: roll(lambda x: F.percentile(x, q), c, days, YEAR, 60)
    add({"inflation_expectations_elevated": flag(F.col("breakeven_inflation_10y") > quarter("breakeven_inflation_10y", 0.75))}, "breakeven_inflation_10y")

    flows = [c for c in df.columns if c.endswith("_abnormal_volume")]
    add({"aggregate_flow_signal": _composite(flows, have)})
    add({n: F.col(c) for n, c in FLOW_NAMES.items() if c in have})
    for name, members in COMPOSITES.items():
        add({name: _composite(members, have)})
    if have & set(GROWTH) and have & set(INFLATION):
        add({"growth_composite": _composite(GROWTH, have), "inflation_composite": _composite(INFLATION, have)})
        slow, dear = F.col("growth_composite") < quarter("growth_composite", 0.25), F.col("inflation_composite") > quarter("inflation_composite", 0.75)
        add({"stagflation_risk": flag(slow & dear)})
    sides = {"<": Column.__lt__, ">": Column.__gt__, ">=": Column.__ge__}
    add({n: flag(sides[side](F.col(c), F.lit(bound))) for n, (c, side, bound) in FLAGS.items() if c in have})
    return df
