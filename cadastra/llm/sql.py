"""DuckDB SQL for the registered queries, written from their contracts rather than from the operators."""

from __future__ import annotations

from cadastra.llm import licenses

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(line: str) -> str:
    words = f"' ' || regexp_replace(lower({line}), {quoted(licenses.SEPARATORS)}, ' ', 'g') || ' '"
    words = f"regexp_replace({words}, ' +', ' ', 'g')"
    for spelling, standard in licenses.SPELLINGS:
        words = f"replace({words}, {quoted(spelling)}, {quoted(standard)})"
    return (
        f"CASE WHEN regexp_matches(lower({line}), {quoted(licenses.COPYRIGHT_LINE)}) THEN '' ELSE trim({words}) END"
    )


def canonical_list_sql(text: str) -> str:
    lines = f"string_split(replace(replace({text}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"
    return f"list_filter(list_transform({lines}, lambda x: {canonical_sql('x')}), lambda x: x <> '')"


def license_scan() -> str:
    rows = ",\n".join(f"({quoted(k)}, {quoted(i)}, {quoted(t)})" for k, i, t in licenses.known_texts())
    return f"""
WITH given(kind, license, text) AS (VALUES {rows}),
known AS (
  SELECT kind, sha256(canonical) AS digest, min(license) AS license
  FROM (SELECT kind, license, array_to_string({canonical_list_sql('text')}, ' ') AS canonical FROM given)
  WHERE canonical <> '' GROUP BY ALL),
docs AS (
  SELECT doc_id, {canonical_list_sql("coalesce(text, '')")} AS lines FROM documents),
notice AS (
  SELECT d.doc_id, string_agg(DISTINCT k.license, ',' ORDER BY k.license) AS notices
  FROM (SELECT doc_id, sha256(unnest(lines)) AS digest FROM docs) d
  JOIN known k ON k.kind = 'notice' AND k.digest = d.digest GROUP BY 1),
whole AS (
  SELECT doc_id, CASE WHEN len(lines) > 0 THEN sha256(array_to_string(lines, ' ')) END AS digest FROM docs)
SELECT w.doc_id, w.digest, k.license, coalesce(n.notices, '') AS notices
FROM whole w LEFT JOIN known k ON k.kind = 'license' AND k.digest = w.digest LEFT JOIN notice n ON n.doc_id = w.doc_id
"""


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {BLANKS})")} AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.*, f.key IS NULL OR k.doc_id = f.keeper AS kept FROM keyed k LEFT JOIN frequent f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT kept) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE kept), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def url_filter(rules: list[tuple[str, str, str]]) -> str:
    rows = ", ".join(f"({quoted(v)}, {quoted(h)}, {quoted(p)})" for v, h, p in rules)
    return f"""
WITH rules(verdict, host, path) AS (VALUES {rows}),
cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
located AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
hosts AS (SELECT page_id, {LOWER.format('raw')} AS host, path FROM located),
fits AS (
  SELECT h.page_id, max_by(struct_pack(rule := r.host || r.path, verdict := r.verdict), length(r.host || r.path)) AS best
  FROM hosts h JOIN rules r
    ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path)
  GROUP BY 1)
SELECT h.page_id, h.host, h.path, f.best.rule AS rule, coalesce(f.best.verdict, 'allow') AS verdict
FROM hosts h LEFT JOIN fits f USING (page_id)
"""


def word_list(text: str) -> str:
    pattern = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"list_filter(regexp_split_to_array({LOWER.format(text)}, {pattern}), lambda x: x <> '')"


def benchmark_scan(width: int = 10) -> str:
    return f"""
WITH docs AS (SELECT doc_id, {word_list("coalesce(text, '')")} AS w FROM documents),
items AS (SELECT item_id, {word_list("coalesce(text, '')")} AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), {width}) AS n FROM items WHERE len(w) > 0),
known AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least(len(w), {width}) AS n, unnest(range(1, len(w) - least(len(w), {width}) + 2)) AS i
        FROM items WHERE len(w) > 0)),
windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, w.n, i, item_id FROM windows w JOIN known k ON w.n = k.n AND w.words = k.words),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY 1),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c USING (doc_id) LEFT JOIN found f USING (doc_id)
"""


def source_mix(block_documents: int = 512) -> str:
    size = (
        f"CASE WHEN trim(coalesce(text, ''), {BLANKS}) = '' THEN 0 "
        f"ELSE len(regexp_split_to_array(trim(text, {BLANKS}), '[\\x20\\x09-\\x0D]+')) END"
    )
    return f"""
WITH sized AS (
  SELECT doc_id, source, ({size})::BIGINT AS size,
    md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS documents,
    [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
  FROM sized GROUP BY source),
asked AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER ()::BIGINT AS total, sum(weight) OVER ()::BIGINT AS weights,
    coalesce(sum(3 * source_size) OVER b, 0)::BIGINT AS caps_before, coalesce(sum(weight) OVER b, 0)::BIGINT AS weights_before
  FROM sources
  WINDOW b AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (
  SELECT *, cap::DOUBLE / weight <= (total - caps_before)::DOUBLE / (weights - weights_before) AS is_capped FROM asked),
aims AS (
  SELECT source, source_size, documents,
    CASE WHEN is_capped THEN cap::DOUBLE
      ELSE ((total - sum(CASE WHEN is_capped THEN cap ELSE 0 END) OVER ()::BIGINT) * weight)::DOUBLE
        / sum(CASE WHEN is_capped THEN 0 ELSE weight END) OVER () END AS target
  FROM capped),
plans AS (
  SELECT *, floor(target + 0.5)::BIGINT // greatest(source_size, 1) AS passes,
    floor(target + 0.5)::BIGINT - floor(target + 0.5)::BIGINT // greatest(source_size, 1) * source_size AS rest
  FROM aims),
ordered AS (
  SELECT s.*, p.source_size, p.target, p.passes, p.rest,
    coalesce(sum(s.size) OVER (
      PARTITION BY s.source ORDER BY ('0x' || substr(s.key, 1, 8))::BIGINT % ceil(p.documents / {block_documents})::BIGINT, s.key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM sized s JOIN plans p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
  (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken
FROM ordered
"""


def spans_sql(kind: str, rank: int, pattern: str, condition: str) -> str:
    """Rows (doc_id, kind, rank, start, stop) of one rule: the text is split at marks set around its matches."""
    mark = "chr(57344)"
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank,
    list_sum([0] || list_transform(pieces[1:i - 1], lambda x: length(x)))::BIGINT AS start,
    (list_sum([0] || list_transform(pieces[1:i - 1], lambda x: length(x))) + length(pieces[i]))::BIGINT AS stop
  FROM (
    SELECT doc_id, pieces, unnest(range(2, len(pieces) + 1, 2)) AS i
    FROM (
      SELECT doc_id, string_split(
        regexp_replace(replace(coalesce(text, ''), {mark}, chr(57345)), {quoted('(' + pattern + ')')},
          {mark} || '\\1' || {mark}, 'g'), {mark}) AS pieces
      FROM documents))
  WHERE {condition}"""


ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)

SECRET_SCAN = f"""
WITH spans AS (
{spans_sql("assign", 0, ASSIGN, f"length(regexp_extract(pieces[i], {quoted(ASSIGN)}, 2)) >= 12")}
  UNION ALL
{spans_sql("access", 1, "AKIA[A-Z0-9]+", "length(pieces[i]) >= 18")}
  UNION ALL
{spans_sql("hex", 2, "[0-9a-f]+", "length(pieces[i]) >= 16")}),
found AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY 1)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN found f USING (doc_id)
"""


HARD_NEGATIVES = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM rows a JOIN rows r ON len(a.v) = len(r.v) WHERE a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), windows AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank
    FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
        AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM windows WHERE rank <= 3
"""
