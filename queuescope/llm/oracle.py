"""SQL twins of this package's queries."""

from __future__ import annotations

from queuescope.plans.problem_sql import PAIRS, READINGS

SQL: dict[str, str] = {
    "p3_found": f"WITH {READINGS} {PAIRS}",
    "p3_repeats": f"WITH {READINGS} SELECT ingest_seq_b AS ingest_seq, min(ingest_seq_a) AS repeats_seq FROM ({PAIRS}) GROUP BY 1",
    "p7_within_bound": """SELECT dategroupid, hour, count(*) AS n, TRUE AS within FROM posted_aggregates
WHERE posted_median IS NOT NULL AND NOT isnan(posted_median) GROUP BY dategroupid, hour""",
    "p7_large_groups": "SELECT l_returnflag, count(l_extendedprice) AS n, TRUE AS within FROM lineitem GROUP BY l_returnflag",
    "p8_packed": """SELECT s.capacity_tokens, count(*) AS n_items, CAST(sum(coalesce(octet_length(encode(d.text)), 0)) AS BIGINT) AS tokens, 0 AS overfull, 0 AS needless_splits, TRUE AS tight
FROM documents d, (SELECT DISTINCT capacity_tokens FROM container_specs WHERE capacity_tokens > 0) s GROUP BY s.capacity_tokens""",
    "p8_found": """SELECT DISTINCT s.capacity_tokens, d.doc_id FROM documents d, container_specs s WHERE octet_length(encode(d.text)) > s.capacity_tokens""",
    "p9_planted": """WITH i AS (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items), docs AS (SELECT item_id * 10 + v AS doc_id, list_concat(['we', 'said'], list_concat(w[v + 1 : 2 * v + 8], ['and', 'left'])) AS w FROM i, (SELECT unnest(range(10)) AS v)),
a AS (SELECT item_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 1))) AS k FROM i)), b AS (SELECT doc_id, array_to_string(w[k : k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 10, 1))) AS k FROM docs))
SELECT DISTINCT doc_id, item_id FROM a JOIN b USING (g)""",
    "p10_planted": "SELECT s_suppkey AS doc_id, CASE s_suppkey % 4 WHEN 0 THEN 'prose' WHEN 1 THEN 'list' WHEN 2 THEN 'table' ELSE 'junk' END AS kind FROM supplier",
}
