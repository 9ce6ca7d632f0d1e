"""Synthetic input tables from ``spark.range`` (no base tables needed).

Produces raw tables shaped like the driver's (customer, nation, region,
supplier, orders) with integer-hash draws, then derives the claims tables with
the same code as ``fixtures``. Presets follow the reference generator's sizes
(policyholders, claims, providers, adjusters); nation has one row an adjuster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringwise.config import DEFAULT_AS_OF
from ringwise.functions.keys import draw_sql as d
from ringwise.sources.fixtures import ClaimTables, adjusters_from, claims_from, policyholders_from, providers_from

# Generator presets (policyholders, claims, service providers, adjusters).
PRESETS = {
    "small": (1_000, 5_000, 200, 50),
    "medium": (10_000, 50_000, 1_000, 200),
    "large": (100_000, 1_000_000, 5_000, 500),
}
# Amounts in cents, 85 % from the first range and 15 % from the second.
USUAL_CENTS = (100_000, 2_000_000)
HIGH_CENTS = (2_000_000, 10_000_000)
USUAL_PERCENT = 85
# Fixed value: an amount above this adds to a claim's score.
HIGH_AMOUNT = 50_000.0
# The five region names used as departments, and order fields.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
STATUSES = ["F", "O", "P"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _list(values) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


def _amount(key: str) -> str:
    """Cents: a draw decides on the range, another on the place in it (two primes, as ranges are wider than one)."""
    place = f"({d(key, 7919, 3, 1000003)} * 97 + {d(key, 104723, 11, 10007)})"
    span = lambda r: f"{r[0]} + {place} % {r[1] - r[0] + 1}"
    return f"CASE WHEN {d(key, 48611, 29, 10009)} % 100 < {USUAL_PERCENT} THEN {span(USUAL_CENTS)} ELSE {span(HIGH_CENTS)} END"


def raw_tables(spark: SparkSession, customers: int, orders: int, suppliers: int, adjusters: int = 25) -> dict[str, DataFrame]:
    region = spark.range(len(REGIONS)).selectExpr("cast(id as int) AS r_regionkey", f"get({_list(REGIONS)}, cast(id as int)) AS r_name")
    nation = spark.range(adjusters).selectExpr(
        "cast(id as int) AS n_nationkey", "concat('NATION_', cast(id as string)) AS n_name", "cast(id % 5 as int) AS n_regionkey"
    )
    customer = spark.range(customers).selectExpr(
        "id AS c_custkey",
        "concat('Customer#', lpad(cast(id as string), 9, '0')) AS c_name",
        f"cast({d('id', 7, 3, 25)} as int) AS c_nationkey",
        f"get({_list(SEGMENTS)}, cast({d('id', 11, 5, 10007)} % 5 as int)) AS c_mktsegment",
    )
    supplier = spark.range(suppliers).selectExpr("id AS s_suppkey", "concat('Supplier#', lpad(cast(id as string), 9, '0')) AS s_name")
    orders_df = spark.range(orders).selectExpr(
        "id AS o_orderkey",
        f"{d('id', 104723, 17, 1000003)} % {customers} AS o_custkey",
        f"get({_list(STATUSES)}, cast({d('id', 13, 7, 10009)} % 3 as int)) AS o_orderstatus",
        f"({_amount('id')}) / 100.0D AS o_totalprice",
        f"cast(date_add(DATE'1992-01-01', cast({d('id', 31, 11, 10007)} % 2400 as int)) as timestamp_ntz) AS o_orderdate",
        f"get({_list(PRIORITIES)}, cast({d('id', 17, 3, 10037)} % 5 as int)) AS o_orderpriority",
    )
    return {"region": region, "nation": nation, "customer": customer, "supplier": supplier, "orders": orders_df}


def generate_tables(spark: SparkSession, preset: str = "small", as_of: str = DEFAULT_AS_OF) -> ClaimTables:
    customers, orders, suppliers, adjusters = PRESETS[preset]
    raw = raw_tables(spark, customers, orders, suppliers, adjusters)
    return ClaimTables(
        policyholders=policyholders_from(raw["customer"], as_of),
        adjusters=adjusters_from(raw["nation"], raw["region"]),
        service_providers=providers_from(raw["supplier"]),
        claims=claims_from(raw["orders"], suppliers, as_of, adjusters, HIGH_AMOUNT),
    )
