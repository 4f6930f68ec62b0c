"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from . import mixing, quality

SP = r"\x20\x09-\x0D"


def _quality() -> str:
    q = quality
    m = len(q.RULES)
    votes = ", ".join(f"CASE WHEN {c} THEN {v} ELSE 0 END" for c, v in q.RULES.values())
    at = "6 * {j} + 3 + v[{j} + 1]".format
    score = " + ".join(["ln(s[1]) - ln(1 - s[1])"] + [f"ln(s[{at(j=j)}]) - ln(s[{at(j=j)} + 3])" for j in range(m)])
    sm = q.SMOOTHING
    cells = ", ".join([f"(sum(n * g) + {sm}) / (sum(n) + {2 * sm})"] + [
        f"(sum(CASE v[{j + 1}] WHEN {x} THEN n * {g} ELSE 0.0 END) + {sm}) / (sum(n * {g}) + {3 * sm})"
        for j in range(m) for g in ("g", "(1 - g)") for x in (-1, 0, 1)])
    return f"""
WITH RECURSIVE t AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{SP}]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{SP}]')) AS l
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i:i + 7] AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM t)),
repeated AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows) WHERE c > 1),
spans AS (
  SELECT doc_id, sum(least(8, coalesce(nxt - i, 8))) AS n
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM repeated) GROUP BY doc_id),
numbers AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[{SP}]+', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         len(l) AS n_text_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '[.!?"][{SP}]*\\z'))) AS n_ended_lines,
         length(t) - length(regexp_replace(t, '\\p{{Lu}}+', '', 'g')) AS n_upper,
         length(t) - length(replace(t, '!', '')) AS n_exclaim,
         len(list_filter(w, lambda x: x = '|')) AS n_bars,
         len(list_distinct(w)) AS n_distinct_words,
         coalesce(spans.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN spans USING (doc_id)),
voted AS (SELECT *, [{votes}] AS v FROM numbers),
patterns AS (SELECT v, count(*)::DOUBLE AS n FROM voted GROUP BY v),
em AS (
  SELECT 1 AS i, [{cells}]::DOUBLE[] AS s
  FROM (SELECT n, v, CASE WHEN list_sum(v) > 0 THEN {q.START} WHEN list_sum(v) < 0 THEN {1 - q.START} ELSE 0.5 END AS g FROM patterns)
  UNION ALL
  SELECT i + 1, [{cells}]::DOUBLE[]
  FROM (SELECT i, n, v, 1 / (1 + exp(-({score}))) AS g FROM em, patterns WHERE i < {q.ITERATIONS}) GROUP BY i),
judged AS (
  SELECT voted.*, round(1 / (1 + exp(-({score}))), 6) AS posterior
  FROM voted, (SELECT s FROM em WHERE i = {q.ITERATIONS}))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND posterior >= 0.5 AS kept, posterior
FROM judged"""


_LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos, len(l) AS n_lines
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[{SP}]+|[{SP}]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT keyed.*, coalesce(doc_id < last_doc, false) AS dropped FROM keyed LEFT JOIN common USING (key))
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


_MIXING = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(t, '[^{SP}]+'))::BIGINT AS size,
         length(t) - length(regexp_replace(t, '\\p{{L}}+', '', 'g')) AS letters,
         length(regexp_replace(t, '[{SP}]+', '', 'g')) AS chars,
         (('0x' || substr(md5('{mixing.SEED}' || chr(31) || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52} AS u
  FROM d),
keyed AS (
  SELECT *, -ln(u) / CASE WHEN chars = 0 THEN 1.0::DOUBLE ELSE 0.1::DOUBLE + 0.9::DOUBLE * letters / chars END AS key FROM sized),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][n % 3 + 1]::BIGINT AS w, 2 * source_size AS cap, 3 * sum(source_size) OVER () AS halves FROM src),
filled AS (
  SELECT *, coalesce(sum(cap) OVER before, 0) AS before, sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS others FROM weighed
  WINDOW before AS (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, (halves - 2 * before) * w >= 2 * cap * others AS is_full FROM filled),
targets AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE
    (w * (halves - 2 * coalesce(sum(cap) FILTER (WHERE is_full) OVER (), 0)))::DOUBLE
    / (2 * sum(w) FILTER (WHERE NOT is_full) OVER ())::DOUBLE END AS target FROM capped),
rests AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS epochs FROM targets),
ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) AS through FROM keyed)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN 2 * through - size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM ordered JOIN rests ON ordered.source IS NOT DISTINCT FROM rests.source"""


_FILTER_AUDIT = f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^{SP}]+') AS w FROM documents),
f AS (
  SELECT doc_id, part,
         (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END)
         || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
         || (CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 'C' ELSE '' END)
         || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
         || (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
  FROM d),
g AS (
  SELECT f.*, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM f LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l USING (doc_id)),
c AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM g GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS o FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT o, s::INTEGER AS s, o[s] AS own, '[' || o[1:s - 1] || ' ]' AS before, '[' || o[1:s] || ']' AS through FROM orders, range(1, 6) r(s)),
told AS (
  SELECT part, o, s, own,
    sum(CASE WHEN NOT regexp_matches(failed, through) THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN contains(failed, own) AND NOT regexp_matches(failed, before) THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN contains(failed, own) AND regexp_matches(failed, before) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN contains(failed, own) AND NOT regexp_matches(failed, before) THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN contains(failed, own) AND NOT regexp_matches(failed, before) THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, steps GROUP BY part, o, s, own)
SELECT part, o AS filter_order, s AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM told"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": _quality(), "op5_mixing": _MIXING, "op9_line_dedup": _LINE_DEDUP,
            "op13_filter_audit": _FILTER_AUDIT}
