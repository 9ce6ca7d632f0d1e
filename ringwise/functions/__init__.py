"""Scalar column helpers (all JVM-side built-ins, no Python UDFs)."""

from ringwise.functions.keys import draw_sql, key_sql, pick_sql
from ringwise.functions.exact import half_up_ratio, half_up_mean_milli, pct_one_decimal, risk_bucket

__all__ = ["draw_sql", "key_sql", "pick_sql", "half_up_ratio", "half_up_mean_milli", "pct_one_decimal", "risk_bucket"]
