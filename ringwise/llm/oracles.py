"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from ringwise.llm import secrets


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def secret_scan(live_owners: int = 1, copied_owners: int = 3, copied_places: int = 10) -> str:
    """op11: matches by ``regexp_extract_all``, their places by running sums of the lengths of matches and pieces."""
    assign = _quoted(secrets.KINDS[0][1])
    kinds = []
    for k, (_, pattern, group, least) in enumerate(secrets.KINDS):
        rx, body = _quoted(pattern), "masked" if k == secrets.OPAQUE else "body"
        mixed = "AND regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]')" if k == secrets.OPAQUE else ""
        kinds.append(
            f"""
SELECT row, doc_id, owner, body, {k} AS kind, stop - length(whole) AS start, stop, value FROM (
  SELECT *, sum(length(piece) + length(whole)) OVER (PARTITION BY row ORDER BY i) AS stop FROM (
    SELECT row, doc_id, owner, body, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS whole, unnest(v) AS value, unnest(p[:len(w)]) AS piece FROM (
      SELECT row, doc_id, owner, body, regexp_extract_all({body}, {rx}, 0) AS w, regexp_extract_all({body}, {rx}, {group}) AS v,
             string_split_regex({body}, {rx}) AS p FROM masked)))
WHERE length(value) >= {least} {mixed}"""
        )
    names = "[" + ", ".join(_quoted(k[0]) for k in secrets.KINDS) + "]"

    def printed(test: str) -> str:
        one = f"{names}[kind + 1] || ':' || start || ':' || stop"
        return f"coalesce(string_agg({one}, ',' ORDER BY start, kind, stop) FILTER (WHERE {test}), '')"

    counts = "".join(f"count(*) FILTER (WHERE kind = {k}) AS n_{secrets.KINDS[k][0]}, " for k in range(secrets.N_BASE))
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body, source AS owner FROM documents),
masked AS (
  SELECT *, array_to_string(list_transform(list_zip(string_split_regex(body, {assign}), regexp_extract_all(body, {assign}, 0)),
                            lambda x: x[1] || repeat(' ', coalesce(length(x[2]), 0))), '') AS masked FROM docs),
found AS ({' UNION ALL '.join(kinds)}),
known AS (
  SELECT value, count(DISTINCT coalesce('=' || owner, '-')) AS owners, count(DISTINCT coalesce('=' || owner, '-') || '|' || body) AS places
  FROM found GROUP BY value),
judged AS (
  SELECT f.*, CASE WHEN owners >= {copied_owners} OR places >= {copied_places} THEN 'copied'
    WHEN owners <= {live_owners} AND len(list_distinct(string_split(value, ''))) >= {secrets.LEAST_DISTINCT}
         AND NOT regexp_matches(lower(value), {_quoted(secrets.EXAMPLE)}) THEN 'live'
    ELSE 'unclear' END AS verdict
  FROM found f JOIN known USING (value)),
kept AS (SELECT * FROM judged WHERE kind < {secrets.N_BASE} OR verdict = 'live')
SELECT d.doc_id, {counts}
  sha256({printed(f'kind < {secrets.N_BASE}')}) AS base_sha256, {printed('kind IS NOT NULL')} AS spans,
  count(*) FILTER (WHERE kind >= {secrets.N_BASE}) AS n_added,
  {printed("verdict = 'live'")} AS live_spans, {printed("verdict = 'copied'")} AS copied_spans
FROM docs d LEFT JOIN kept k USING (row) GROUP BY d.row, d.doc_id"""


#: op12: all anchors with all rows; integer products summed as doubles, which hold them exactly here.
HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, b.row, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row <> b.row WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score, CAST(row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) AS INTEGER) AS positive_rank
  FROM s WHERE same QUALIFY positive_rank <= 5)
SELECT p.anchor_id, p.positive_id, p.positive_rank,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.positive_rank ORDER BY n.score DESC, n.vec_id, n.row) AS INTEGER) AS rank,
       n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5"""


#: op13: every term's occurrences in every document, joined to the items' terms.
RANKED_SEARCH = r"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents),
found AS (SELECT row, doc_id, unnest(regexp_extract_all(body, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM found GROUP BY row, doc_id, term),
n AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM n),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (SELECT row_number() OVER () AS item, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM benchmark),
asked AS (SELECT item, item_id, unnest(regexp_extract_all(body, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
weighed AS (
  SELECT item, item_id, term, count(*) * CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * any_value(df) + 1))) AS BIGINT) AS w
  FROM asked JOIN df USING (term) CROSS JOIN total GROUP BY item, item_id, term),
scored AS (
  SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // length))))::BIGINT AS score
  FROM weighed JOIN tf USING (term) JOIN n USING (row) CROSS JOIN total GROUP BY item, item_id, row, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, row) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20"""
