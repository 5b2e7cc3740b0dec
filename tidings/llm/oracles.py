"""SQL of the pN_ queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

_BLANK = r"[\s\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_BLANK}+|{_BLANK}+$', '', 'g')"


_RANKED = f"""
WITH d AS (SELECT DISTINCT id, dedup_key, source_id, {_strip("source_name")} AS n, lower({_strip("severity")}) AS sev, occurred_at, ingested_at, published_at FROM reports WHERE dedup_key IS NOT NULL AND id IS NOT NULL),
g AS (SELECT dedup_key FROM d GROUP BY dedup_key HAVING count(DISTINCT id) >= 2),
r AS (
  SELECT d.*, b.name AS usable, coalesce(CASE WHEN source_id IS NOT NULL THEN a.trust_score ELSE b.trust_score END, -2147483648) AS trust,
    CASE WHEN occurred_at >= TIMESTAMPTZ '2001-01-01 00:00:00+00' AND (ingested_at IS NULL OR occurred_at <= ingested_at) THEN occurred_at END AS happened
  FROM d JOIN g USING (dedup_key) LEFT JOIN sources a ON a.id = d.source_id LEFT JOIN sources b ON b.name = n
)
"""

P1_FOUND = _RANKED + """
SELECT dedup_key, 'source_name' AS field, arg_max(id, (trust, coalesce(published_at, TIMESTAMPTZ '1970-01-01 00:00:00+00'), usable, id)) AS id FROM r WHERE usable IS NOT NULL GROUP BY dedup_key
UNION ALL SELECT dedup_key, 'severity', arg_max(id, (trust, coalesce(published_at, TIMESTAMPTZ '1970-01-01 00:00:00+00'), sev, id)) FROM r WHERE sev IN ('low', 'medium', 'high', 'critical') GROUP BY dedup_key
UNION ALL SELECT dedup_key, 'occurred_at', arg_max(id, (happened, id)) FROM r WHERE happened IS NOT NULL GROUP BY dedup_key
"""  # fmt: skip

_LINES = rf"""
WITH d AS (SELECT DISTINCT reports.id, s.name AS source, content FROM reports JOIN sources s ON s.name = {_strip("source_name")} WHERE reports.id IS NOT NULL),
l AS (SELECT id, source, unnest(string_split(content, chr(10))) AS line, unnest(range(len(string_split(content, chr(10))))) AS line_no FROM d),
k AS (SELECT id, source, line_no, trim(regexp_replace(regexp_replace(lower(line), '{_BLANK}+', ' ', 'g'), '\p{{Nd}}+', '0', 'g')) AS k FROM l),
n AS (SELECT source, count(*) AS docs FROM d GROUP BY source),
c AS (SELECT source, k, count(DISTINCT id) AS reports FROM k WHERE k <> '' GROUP BY source, k),
kept AS (SELECT source, k FROM c JOIN n USING (source) WHERE reports >= 4 AND reports >= docs * 0.1)
"""

P2_FOUND = _LINES + "SELECT id, line_no::INT AS line_no FROM k JOIN kept USING (source, k)"


_BLOCKS = _LINES.replace("WITH d", "WITH RECURSIVE d", 1) + """,
s AS (SELECT id, source, k, lead(k) OVER (PARTITION BY id ORDER BY line_no) AS b FROM k WHERE k <> ''),
e AS (SELECT source, k AS a, b FROM s JOIN n USING (source) WHERE b IS NOT NULL GROUP BY source, k, b HAVING count(DISTINCT id) >= 4 AND count(DISTINCT id) >= max(docs) * 0.1),
reach AS (SELECT source, k AS x, k AS y FROM kept UNION SELECT r.source, r.x, CASE WHEN e.a = r.y THEN e.b ELSE e.a END FROM reach r JOIN e ON e.source = r.source AND (e.a = r.y OR e.b = r.y)),
comp AS (SELECT source, x AS k, min(y) AS block FROM reach GROUP BY source, x)
"""

P2_BLOCKS = _BLOCKS + "SELECT source, block, k AS line, reports FROM comp JOIN c USING (source, k)"

P2_CLEAN = _BLOCKS + """,
m AS (SELECT k.id, k.line_no, k.k, l.line, coalesce(block, '') AS block FROM k JOIN l USING (id, line_no) LEFT JOIN comp ON comp.source = k.source AND comp.k = k.k),
w AS (SELECT *, last_value(CASE WHEN k <> '' THEN block END IGNORE NULLS) OVER (PARTITION BY id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
  first_value(CASE WHEN k <> '' THEN block END IGNORE NULLS) OVER (PARTITION BY id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM m),
z AS (SELECT id, coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT coalesce(block <> '' OR (k = '' AND before = after AND before <> ''), false)), '') AS content FROM w GROUP BY id)
SELECT r.id, coalesce(z.content, r.content) AS content FROM (SELECT DISTINCT id, content FROM reports WHERE id IS NOT NULL) r LEFT JOIN z USING (id)
"""

P1_SURVIVORS = _RANKED + """,
v AS (SELECT dedup_key,
  arg_max(struct_pack(v := usable, i := id), (trust, TS, usable, id)) FILTER (usable IS NOT NULL) AS n,
  arg_max(struct_pack(v := sev, i := id), (trust, TS, sev, id)) FILTER (sev IN ('low', 'medium', 'high', 'critical')) AS s,
  arg_max(struct_pack(v := happened, i := id), (happened, id)) FILTER (happened IS NOT NULL) AS o FROM r GROUP BY dedup_key)
SELECT dedup_key, n.v AS source_name, n.i AS source_name_id, s.v AS severity, s.i AS severity_id, o.v AS occurred_at, o.i AS occurred_at_id FROM v
""".replace("TS", "coalesce(published_at, TIMESTAMPTZ '1970-01-01 00:00:00+00')")


def oracle_sql() -> dict[str, str]:
    return {"p1_found": P1_FOUND, "p1_survivors": P1_SURVIVORS, "p2_found": P2_FOUND, "p2_blocks": P2_BLOCKS, "p2_clean": P2_CLEAN}
