"""DuckDB oracle: the fixture tables and the claims graph as SQL CTEs.

The oracle is an independent formulation (e.g. shared contacts as the OR-join
the reference wrote), rebuilt from the same raw tables. Query modules append
their own CTEs and a final SELECT.
"""

from __future__ import annotations

from ringwise import config as C

TIERS = ["Standard", "Silver", "Gold", "Platinum"]
AS_OF = f"DATE '{C.DEFAULT_AS_OF}'"


def _d(x: str, a: int, b: int, p: int) -> str:
    return f"(({x}*{a}+{b})%{p})"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _key(prefix: str, x: str, width: int) -> str:
    digits = f"CAST({x} AS VARCHAR)"
    return f"('{prefix}' || repeat('0', greatest(0, {width} - length({digits}))) || {digits})"


def _milli_to_double(x: str) -> str:
    return f"(CAST({x} AS DOUBLE) / 1000.0)"


def half_up_mean_milli(sum_expr: str, n_expr: str) -> str:
    return f"CASE WHEN ({n_expr}) > 0 THEN CAST((2*CAST({sum_expr} AS BIGINT) + ({n_expr})) // (2*({n_expr})) AS DOUBLE) / 1000.0 END"


def pct_one_decimal(part: str, whole: str) -> str:
    return (
        f"CASE WHEN ({whole}) > 0 THEN CAST((2*CAST({part} AS BIGINT)*1000 + ({whole})) // (2*({whole})) AS DOUBLE) / 10.0 "
        "ELSE 0.0 END"
    )


c = "c_custkey"
k = "o_orderkey"

POLICYHOLDERS = f"""
policyholders AS (
  SELECT {_key('PH', c, 8)} AS policyholder_id,
         c_name AS name,
         CASE WHEN {c} < 20 THEN 'RING-ADDR-' || CAST({c} // 5 AS VARCHAR)
              WHEN {_d(c, 7919, 13, 10007)} < 7005 THEN 'ADDR-' || CAST({c} AS VARCHAR)
              ELSE 'SHARED-' || CAST({_d(c, 104729, 7, 10009)} % 100 AS VARCHAR) END AS address,
         'CITY-' || CAST({_d(c, 7919, 13, 10007)} % 10 AS VARCHAR) AS city,
         'STATE-' || CAST({_d(c, 104729, 7, 10009)} % 10 AS VARCHAR) AS state,
         CASE WHEN {c} < 20 THEN 'RING-TEL-' || CAST({c} // 5 AS VARCHAR)
              WHEN {_d(c, 15485863, 11, 10037)} < 8030 THEN 'TEL-' || CAST({c} AS VARCHAR)
              ELSE 'SHARED-' || CAST({_d(c, 32452843, 5, 10039)} % 50 AS VARCHAR) END AS phone,
         lower(regexp_replace({_key('PH', c, 8)}, '[^a-zA-Z0-9]', '', 'g')) || '@email.com' AS email,
         CAST({AS_OF} - CAST({_d(c, 15485863, 11, 10037)} % 1825 AS INTEGER) AS DATE) AS policy_start_date,
         CAST(18 + {_d(c, 49979687, 9, 10061)} % 62 AS INTEGER) AS age,
         {_list(TIERS)}[CAST({_d(c, 32452843, 5, 10039)} % 4 AS INTEGER) + 1] AS customer_tier,
         c_mktsegment AS segment,
         c_nationkey AS nation_key
  FROM customer
)"""

ADJUSTERS = f"""
adjusters AS (
  SELECT {_key('ADJ', 'CAST(n_nationkey AS BIGINT)', 6)} AS adjuster_id,
         n_name AS name,
         r_name AS department,
         CAST(1 + {_d('CAST(n_nationkey AS BIGINT)', 7919, 13, 10007)} % 20 AS INTEGER) AS years_experience,
         {_key('LIC-', 'n_nationkey', 8)} AS license_number
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
)"""

SERVICE_PROVIDERS = f"""
service_providers AS (
  SELECT {_key('SP', 's_suppkey', 6)} AS service_provider_id,
         s_name AS provider_name,
         'TYPE-' || CAST(s_suppkey % 6 AS VARCHAR) AS service_type,
         CAST(10 + {_d('s_suppkey', 104729, 7, 10009)} % 41 AS DOUBLE) / 10.0 AS rating,
         CAST(1 + {_d('s_suppkey', 15485863, 11, 10037)} % 30 AS INTEGER) AS years_in_business,
         'CITY-' || CAST({_d('s_suppkey', 7919, 13, 10007)} % 10 AS VARCHAR) AS city
  FROM supplier
)"""

CLAIMS = f"""
claims_keyed AS (
  SELECT {k} AS k,
         CASE WHEN {_d(k, 7919, 13, 10007)} < 2001 THEN {_d(k, 31, 1, 10009)} % 15 ELSE o_custkey END AS p,
         CASE WHEN {_d(k, 104729, 7, 10009)} < 2502 THEN {_d(k, 37, 1, 10037)} % 5 ELSE {_d(k, 41, 3, 10039)} % 25 END AS a,
         CASE WHEN {_d(k, 15485863, 11, 10037)} < 3011 THEN {_d(k, 43, 1, 10061)} % 8
              ELSE {_d(k, 47, 3, 10067)} % (SELECT count(*) FROM supplier) END AS s,
         o_orderpriority AS claim_type,
         o_orderstatus AS status,
         CAST(o_orderdate AS DATE) AS incident_date,
         o_totalprice AS claim_amount
  FROM orders
),
claims_scored AS (
  SELECT *,
         CAST(greatest(least(100 + {_d('k', 32452843, 5, 10039)} % 801
              + CASE WHEN p < 15 THEN 400 ELSE 0 END
              + CASE WHEN a < 5 THEN 350 ELSE 0 END
              + CASE WHEN s < 8 THEN 300 ELSE 0 END
              + CASE WHEN claim_amount > 400000 THEN 200 ELSE 0 END
              + CASE WHEN claim_type = '1-URGENT' THEN 150 ELSE 0 END
              + {_d('k', 49979687, 9, 10061)} % 151 - 75, 1000), 0) AS INTEGER) AS score_milli,
         CAST(incident_date + CAST(1 + {_d('k', 7, 5, 30)} AS INTEGER) AS DATE) AS filing_date
  FROM claims_keyed
),
claims AS (
  SELECT {_key('CLM', 'k', 10)} AS claim_id,
         {_key('PH', 'p', 8)} AS policyholder_id,
         {_key('ADJ', 'a', 6)} AS adjuster_id,
         {_key('SP', 's', 6)} AS service_provider_id,
         claim_type, incident_date, filing_date, claim_amount,
         CAST(round(claim_amount * 100) AS BIGINT) AS amount_cents,
         status, score_milli,
         {_milli_to_double('score_milli')} AS fraud_score,
         CAST({AS_OF} - filing_date AS INTEGER) AS processing_days,
         CAST(filing_date - incident_date AS INTEGER) AS days_to_file
  FROM claims_scored
)"""

VERTICES = """
vertices AS (
  SELECT claim_id AS id, 'claim' AS type, CAST(NULL AS VARCHAR) AS name, fraud_score, score_milli,
         claim_amount AS amount, claim_type AS category, status, CAST(NULL AS VARCHAR) AS address,
         CAST(NULL AS VARCHAR) AS phone, incident_date AS event_date
  FROM claims
  UNION ALL
  SELECT policyholder_id, 'policyholder', name, NULL, NULL, NULL, customer_tier, NULL, address, phone, policy_start_date
  FROM policyholders
  UNION ALL
  SELECT adjuster_id, 'adjuster', name, NULL, NULL, NULL, department, NULL, NULL, NULL, NULL FROM adjusters
  UNION ALL
  SELECT service_provider_id, 'provider', provider_name, NULL, NULL, NULL, service_type, NULL, NULL, NULL, NULL
  FROM service_providers
)"""


def _collab(name: str, left: str, right: str, min_claims: int) -> str:
    return f"""
{name} AS (
  SELECT {left} AS src, {right} AS dst, count(*) AS claim_count,
         CAST(sum(score_milli) AS DOUBLE) / CAST(count(*) * 1000 AS DOUBLE) AS fraud_score
  FROM claims GROUP BY {left}, {right} HAVING count(*) >= {min_claims}
)"""


EDGES = (
    """
shared_pairs AS (
  SELECT DISTINCT a.policyholder_id AS src, b.policyholder_id AS dst
  FROM policyholders a JOIN policyholders b
    ON a.policyholder_id < b.policyholder_id AND (a.address = b.address OR a.phone = b.phone)
),"""
    + _collab("pairs_ph_adj", "policyholder_id", "adjuster_id", 2)
    + ","
    + _collab("pairs_ph_prov", "policyholder_id", "service_provider_id", 2)
    + ","
    + _collab("pairs_adj_prov", "adjuster_id", "service_provider_id", 3)
    + f""",
edges AS (
  SELECT claim_id AS src, policyholder_id AS dst, 'filed_by' AS relationship, filing_date AS edge_date,
         fraud_score, CAST(1 AS BIGINT) AS claim_count FROM claims
  UNION ALL SELECT claim_id, adjuster_id, 'processed_by', filing_date, fraud_score, 1 FROM claims
  UNION ALL SELECT claim_id, service_provider_id, 'serviced_by', incident_date, fraud_score, 1 FROM claims
  UNION ALL SELECT src, dst, 'shared_contact', {AS_OF}, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT) FROM shared_pairs
  UNION ALL SELECT src, dst, 'repeat_adjuster', {AS_OF}, fraud_score, claim_count FROM pairs_ph_adj
  UNION ALL SELECT src, dst, 'repeat_provider', {AS_OF}, fraud_score, claim_count FROM pairs_ph_prov
  UNION ALL SELECT src, dst, 'frequent_collaboration', {AS_OF}, fraud_score, claim_count FROM pairs_adj_prov
)"""
)

BASE = ",".join([POLICYHOLDERS, ADJUSTERS, SERVICE_PROVIDERS, CLAIMS, VERTICES, EDGES])


def view_edges_sql(name: str, relationships) -> str:
    rels = ", ".join(f"'{r}'" for r in relationships)
    return f"\n{name} AS (SELECT * FROM edges WHERE relationship IN ({rels}))"


def with_base(*ctes: str, select: str) -> str:
    """Full oracle statement: base CTEs, extra CTEs, final SELECT."""
    parts = [BASE] + [c for c in ctes if c]
    return "WITH RECURSIVE " + ",".join(parts) + "\n" + select
