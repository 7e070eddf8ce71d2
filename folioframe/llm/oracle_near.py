"""Near-duplicate components in DuckDB SQL: exact similarity of all pairs that share a shingle."""

from folioframe.llm.near_dedup import PERCENT, SHINGLE


def components_sql(source: str, size: int = SHINGLE, percent: int = PERCENT) -> str:
    """CTEs up to near_components (rid, doc_id, n_shingles, component_id), from a relation with doc_id and text."""
    at = ", ".join(f"lead(w, {k}) OVER o AS w{k}" for k in range(1, size))
    names = ", ".join(["w", *[f"w{k}" for k in range(1, size)]])
    return f"""
nd AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM {source}),
np AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM nd),
nw AS (SELECT rid, w, {at} FROM np WINDOW o AS (PARTITION BY rid ORDER BY i)),
ns AS (SELECT DISTINCT rid, concat_ws(' ', {names}) AS s FROM nw WHERE w{size - 1} IS NOT NULL UNION ALL SELECT rid, array_to_string(ws, ' ') FROM nd WHERE len(ws) BETWEEN 1 AND {size - 1}),
nn AS (SELECT rid, count(*)::BIGINT AS n FROM ns GROUP BY rid),
nl AS (SELECT x.rid AS a, y.rid AS b FROM ns x JOIN ns y ON x.s = y.s AND x.rid < y.rid JOIN nn p ON p.rid = x.rid JOIN nn q ON q.rid = y.rid GROUP BY x.rid, y.rid, p.n, q.n HAVING 100 * count(*) >= {percent} * (p.n + q.n - count(*))),
ne AS (SELECT a, b FROM nl UNION ALL SELECT b, a FROM nl),
reach(rid, node) AS (SELECT rid, rid FROM nd UNION SELECT r.rid, e.b FROM reach r JOIN ne e ON e.a = r.node),
near_components AS (SELECT d.rid, d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, (SELECT min(t.doc_id) FROM reach r JOIN nd t ON t.rid = r.node WHERE r.rid = d.rid) AS component_id FROM nd d LEFT JOIN nn USING (rid))"""


OP7 = f"""WITH RECURSIVE {components_sql("documents")}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM near_components"""
