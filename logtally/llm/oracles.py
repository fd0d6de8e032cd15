"""DuckDB statements of the queries that SQL can express."""

from __future__ import annotations

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"len(regexp_extract_all({}, '[^\x20\x09-\x0D]+'))"

_LINES = f"""
WITH lines AS (
  SELECT doc_id, source, generate_subscripts(parts, 1) - 1 AS pos, unnest(parts) AS raw
  FROM (SELECT doc_id, source, string_split(text, chr(10)) AS parts FROM documents)),
judged AS (
  SELECT doc_id, pos, coalesce(source, '') AS site, trim(raw, {_BLANK}) AS line FROM lines
  WHERE {_WORDS.format("raw")} >= 3),
common AS (
  SELECT line, min((doc_id, pos)) AS first FROM judged GROUP BY line HAVING count(DISTINCT site) >= 4),
gone AS (
  SELECT j.doc_id, j.pos FROM judged j JOIN common c ON j.line = c.line WHERE (j.doc_id, j.pos) <> c.first),
kept AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS text,
    string_agg(CAST(l.pos AS VARCHAR), ',' ORDER BY l.pos) FILTER (WHERE g.pos IS NOT NULL) AS removed,
    count(*) FILTER (WHERE g.pos IS NOT NULL) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT doc_id, CAST(len(string_split(coalesce(text, ''), chr(10))) AS BIGINT) AS n_kept,
  CAST(n_removed AS BIGINT) AS n_removed, coalesce(removed, '') AS removed, sha256(coalesce(text, '')) AS clean_sha256
FROM kept
"""

_QUALITY = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || chr(1) || w[i + 1] || chr(1) || w[i + 2] AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM texts WHERE len(w) > 2)),
again AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
under AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT win.doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows win JOIN again USING (doc_id, win)) GROUP BY doc_id),
measures AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(list_aggregate(w, 'string_agg', '')) AS BIGINT) AS chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda line: trim(line, {_BLANK}) <> '') AS lines
  FROM texts),
judged AS (
  SELECT m.doc_id, t, w, n_words, coalesce(chars, 0) AS word_chars, n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n, 0) > 50 * n_words AS base_failed
  FROM measures m LEFT JOIN under u ON m.doc_id = u.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT (
    word_chars < 2 * n_words OR word_chars > 15 * n_words OR 4 * n_symbols > n_words
    OR 2 * n_dup_lines > len(string_split(t, chr(10)))
    OR 10 * len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) < 6 * n_words
    OR (10 * len(list_distinct(w)) < n_words AND len(list_distinct(w)) * len(list_distinct(w)) < 4 * n_words)
    OR coalesce(list_max(list_transform(w, lambda x: length(x))), 0) > 1000) AS kept
FROM judged
"""

_KEY = "(" + "|".join("".join(f"[{c}{c.upper()}]" for c in word) for word in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY])"
_ASSIGN = _KEY + r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _matches(kind: int, pattern: str, group: int) -> str:
    return f"""
  SELECT doc_id, {kind} AS kind, regexp_extract_all(t, '{pattern}') AS found, regexp_extract_all(t, '{pattern}', {group}) AS vals,
    regexp_split_to_array(t, '{pattern}') AS gaps FROM texts"""


_SECRETS = f"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repository, coalesce(text, '') AS t FROM documents),
matched AS ({" UNION ALL ".join([_matches(0, _ASSIGN, 2), _matches(1, "AKIA[A-Z0-9]+", 0), _matches(2, "[0-9a-f]+", 0), _matches(3, "[A-Za-z0-9+/_-]+", 0)])}),
single AS (
  SELECT doc_id, kind, unnest(found) AS match, unnest(vals) AS value, unnest(gaps[1:len(found)]) AS gap, generate_subscripts(found, 1) AS k
  FROM matched WHERE len(found) > 0),
placed AS (
  SELECT doc_id, kind, value, length(match) AS size,
    CAST(sum(length(gap)) OVER upto + sum(length(match)) OVER upto - length(match) AS BIGINT) AS start
  FROM single WINDOW upto AS (PARTITION BY doc_id, kind ORDER BY k)),
spans AS (
  SELECT doc_id, kind, start, start + size AS stop, value FROM placed
  WHERE CASE kind WHEN 0 THEN length(value) >= 12 WHEN 1 THEN size >= 18 WHEN 2 THEN size >= 16
    ELSE size >= 20 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]') END),
apart AS (
  SELECT * FROM spans s WHERE kind < 3 OR NOT EXISTS (
    SELECT 1 FROM spans b WHERE b.kind < 3 AND b.doc_id = s.doc_id AND s.start < b.stop AND b.start < s.stop)),
owned AS (
  SELECT value, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repository)) AS repositories
  FROM apart JOIN texts USING (doc_id) GROUP BY value),
known AS (
  SELECT doc_id, kind, ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop AS written, start,
    CASE WHEN owners >= 3 THEN 'example' WHEN owners <= 1 AND repositories <= 3 THEN 'live' ELSE 'unclear' END AS standing
  FROM apart JOIN owned USING (value)),
per_doc AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
    count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg(written, ',' ORDER BY start, kind) FILTER (WHERE kind < 3) AS base,
    string_agg(written, ',' ORDER BY start, kind) FILTER (WHERE kind < 3 OR standing = 'live') AS spans,
    count(*) FILTER (WHERE kind < 3 AND standing = 'live') AS n_live, count(*) FILTER (WHERE kind < 3 AND standing = 'example') AS n_example
  FROM known GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM texts t LEFT JOIN per_doc p ON t.doc_id = p.doc_id
"""

_EMBEDDINGS = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
smallest AS (SELECT x, min(y) AS component_id FROM reached GROUP BY x)
SELECT vec_id, (SELECT count(*) FROM links l WHERE l.x = vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN smallest ON vec_id = x
"""



def _clusters(rounds: int = 5) -> str:
    """The rounds one after another: nearest centroids, then floored means; ``//`` cuts towards 0, so the sign is minded."""
    near = """
a{k} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, min((list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), n)) AS best
  FROM kept CROSS JOIN c{k} GROUP BY vec_id)"""
    move = """
s{k} AS (SELECT best[2] AS n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{k}),
m{k} AS (SELECT n, list(m ORDER BY i) AS c FROM (SELECT n, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM s{k} GROUP BY n, i) GROUP BY n),
c{next} AS MATERIALIZED (SELECT c{k}.n, coalesce(m{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN m{k} ON c{k}.n = m{k}.n)"""
    steps = ",".join(near.format(k=k) + "," + move.format(k=k, next=k + 1) for k in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h) - 1 AS n, v AS c
  FROM (SELECT v, sha256('2:' || vec_id) AS h FROM kept ORDER BY h LIMIT 40)),{steps},{near.format(k=rounds)}
SELECT vec_id, CAST(best[2] AS INTEGER) AS cluster, CAST(best[1] AS BIGINT) AS distance,
  CAST(sum(best[1]) OVER (PARTITION BY best[2]) AS BIGINT) AS cluster_inertia, CAST(sum(best[1]) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best[2] = n
"""


_DIVERGENCE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
occurring AS (
  SELECT d, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS whole FROM occurring GROUP BY lang, term HAVING count(DISTINCT d) >= 3),
sizes AS (SELECT lang, count(*) AS v, sum(whole) AS n FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS c FROM occurring JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY lang, source),
groups AS (
  SELECT g.lang, g.source, coalesce(v, 0) AS v, coalesce(t.n, 0) AS n FROM (SELECT DISTINCT lang, source FROM docs) g
  LEFT JOIN sizes s ON s.lang = g.lang LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
grid AS (
  SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, CAST(1 + 1000000000 * (coalesce(c, 0) + 1) // (g.n + g.v) AS BIGINT) AS p,
    CAST(1 + 1000000000 * (k.whole + 1) // (s.n + s.v) AS BIGINT) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN sizes s ON s.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM grid WHERE c > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op6_line_dedup": _LINES,
    "op7_secret_scan": _SECRETS,
    "op8_embedding_near_dedup": _EMBEDDINGS,
    "op9_quality_rules": _QUALITY,
    "op12_centroid_clustering": _clusters(),
    "op13_source_divergence": _DIVERGENCE,
}
