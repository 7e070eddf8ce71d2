"""The quality rules in DuckDB SQL."""

from folioframe.llm.quality_rules import MEASURES, NOISE, PRIOR, SPREADS

_CHARS = "' ', chr(9), chr(10), chr(11), chr(12), chr(13)"
_MEASURES = ", ".join(f"('{m}', {m})" for m in MEASURES)


def _fence(keys: str, name: str) -> str:
    part = f"PARTITION BY {keys}, measure" if keys else "PARTITION BY measure"
    group = f"{keys}, measure" if keys else "measure"
    lead = f"{keys}, " if keys else ""
    at = lambda q: f"min(CASE WHEN upto * 100 >= every * {q} THEN bin END)"
    top = "CASE WHEN {0} < 32 THEN {0} ELSE ((({0} - 16 * (({0} - 16) // 16) + 1)::BIGINT) << (({0} - 16) // 16)::INTEGER) - 1 END"
    return f"""
{name}_bins AS (SELECT {lead}measure, bin, sum(n)::BIGINT AS n FROM parts GROUP BY {group}, bin),
{name}_run AS (SELECT *, sum(n) OVER ({part}) AS every, sum(n) OVER ({part} ORDER BY bin) AS upto FROM {name}_bins),
{name}_q AS (SELECT {lead}measure, max(every) AS docs, {at(25)} AS b1, {at(50)} AS b2, {at(75)} AS b3, sum(n * ({top.format("bin")})) AS total FROM {name}_run GROUP BY {group}),
{name}_f AS (SELECT {lead}measure, docs, {top.format("b3")} + {SPREADS} * greatest(({top.format("b3")}) - ({top.format("b1")}), total // docs - ({top.format("b2")})) AS fence FROM {name}_q)"""


_OVER = " OR ".join(f"(p.measure = '{m}' AND {s} * {x} > p.fence * {n} AND ({s} * {x} - p.fence * {n})::DOUBLE * ({s} * {x} - p.fence * {n})::DOUBLE > {x}::DOUBLE * {NOISE * NOISE * unit * s * s}.0::DOUBLE)" for m, (x, n, s, unit) in MEASURES.items())


def measured_sql(source: str) -> str:
    """CTEs up to measured, from a relation with doc_id, text, lang, source."""
    return f"""
t AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS body FROM {source}),
w AS (SELECT rid, list_filter(regexp_split_to_array(body, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws, list_filter(string_split(body, chr(10)), lambda x: translate(x, concat({_CHARS}), '') <> '') AS ls FROM t),
pos AS (SELECT rid, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM w),
win AS (SELECT rid, i, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM pos WINDOW o AS (PARTITION BY rid ORDER BY i)),
dup AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, w, w2, w3) AS c FROM win WHERE w3 IS NOT NULL),
cov AS (SELECT rid, count(DISTINCT j)::BIGINT AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM dup WHERE c > 1) GROUP BY rid),
base AS (SELECT t.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(translate(body, concat({_CHARS}), ''))::BIGINT AS word_chars,
  (length(body) - length(translate(body, '#*$%&|<>', '')))::BIGINT AS n_symbols, (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')))::BIGINT AS n_upper, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t JOIN w USING (rid) LEFT JOIN cov USING (rid)),
measured AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS symbol_pm, coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeat_pm, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_line_pm, coalesce(100 * word_chars // nullif(n_words, 0), 0) AS word_len_pc, coalesce(1000 * n_upper // nullif(word_chars, 0), 0) AS upper_pm FROM base),
parts AS (SELECT lang, source, m.measure, CASE WHEN m.x < 32 THEN m.x ELSE 16 * (length(bin(m.x)) - 5) + (m.x >> (length(bin(m.x)) - 5)::INTEGER) END AS bin, count(*) AS n FROM (SELECT * FROM measured WHERE NOT base_failed), LATERAL (VALUES {_MEASURES}) m(measure, x) GROUP BY ALL),
{_fence("lang, source", "own")},{_fence("lang", "lang")},{_fence("", "total")},
picked AS (SELECT o.lang, o.source, o.measure, (o.fence * o.docs + ((l.fence * l.docs + a.fence * {PRIOR}) // (l.docs + {PRIOR})) * {PRIOR}) // (o.docs + {PRIOR}) AS fence FROM own_f o JOIN lang_f l ON o.lang IS NOT DISTINCT FROM l.lang AND o.measure = l.measure JOIN total_f a ON o.measure = a.measure),
judged AS (SELECT b.*, NOT base_failed AND NOT EXISTS (SELECT 1 FROM picked p WHERE p.lang IS NOT DISTINCT FROM b.lang AND p.source IS NOT DISTINCT FROM b.source AND ({_OVER})) AS kept FROM measured b)"""


OP2 = f"""WITH {measured_sql("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"""
