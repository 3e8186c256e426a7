"""DuckDB SQL for the operators that SQL can express on whole tables."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"


def _levels(t: str, levels: int) -> str:
    """Levels of the trees over ``{t}0(key, pos, n, h)``, and ``{t}p`` steps that fold ``f`` upward beside them."""
    out = []
    for k in range(levels):
        out.append(f"""{t}r{k} AS (SELECT key, pos // 16 AS run, max(n) AS n, list(h ORDER BY pos) AS hs FROM {t}{k} GROUP BY key, pos // 16),
{t}{k + 1} AS (SELECT key, run AS pos, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h
  FROM {t}r{k}),
{t}s{k} AS (SELECT p.*, n > 1 AS up, array_to_string(hs[1:p.pos % 16], '') AS l, array_to_string(hs[p.pos % 16 + 2:], '') AS r
  FROM {t}p{k} p JOIN {t}r{k} x ON p.key = x.key AND p.pos // 16 = x.run),
{t}p{k + 1} AS (SELECT id, doc_id, source, leaf, key, pos // 16 AS pos, CASE WHEN up THEN sha256(l || f || r) ELSE f END AS f,
  CASE WHEN up THEN proof || l || r ELSE proof END AS proof FROM {t}s{k})""")
    return ",\n".join(out)


def _merkle(levels: int = 5) -> str:
    leaf = lambda text: "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH crc AS (SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) x(i)),
base AS (SELECT row_number() OVER () AS id, doc_id, source, coalesce('=' || source, '') AS key, {leaf("text")} AS leaf,
  {leaf(low)} AS other,
  xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 5 = 0 AS hit
  FROM documents, crc),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
  count(*) OVER (PARTITION BY key) AS n FROM base),
a0 AS (SELECT key, pos, n, leaf AS h FROM placed),
ap0 AS (SELECT id, doc_id, source, leaf, key, pos, CASE WHEN hit THEN other ELSE leaf END AS f, '' AS proof FROM placed),
{_levels("a", levels)},
tops AS (SELECT key AS source_key, h, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM a{levels}),
b0 AS (SELECT '' AS key, pos, n, h FROM tops),
bp0 AS (SELECT id, doc_id, source, leaf, '' AS key, tops.pos AS pos, f, proof FROM ap{levels} p JOIN tops ON p.key = source_key),
{_levels("b", levels)}
SELECT p.doc_id, p.leaf, tops.h AS subroot, b{levels}.h AS root, sha256(p.proof) AS proof_sha256, p.f AS folded_root,
  p.f = b{levels}.h AS verified
FROM bp{levels} p JOIN tops ON coalesce('=' || p.source, '') = source_key, b{levels}"""


ORACLE: dict[str, str] = {
    "op2_line_dedup": r"""
WITH base AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)) AS host,
         list_filter(list_transform(string_split(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', chr(10), 'g'), '<[^>]*>', chr(10), 'g'), chr(10)),
           lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda x: x <> '') AS lines
  FROM pages),
totals AS (SELECT host, count(*) AS n_pages FROM base GROUP BY host),
held AS (SELECT host, line, count(*) AS n FROM
  (SELECT host, unnest(list_distinct(lines)) AS line FROM base) GROUP BY host, line),
boiler AS (SELECT host, list(line) AS boiler FROM held JOIN totals USING (host)
  WHERE n > 1 AND n + 2::DOUBLE - 2 * sqrt(n::DOUBLE * (n_pages - n) / n_pages + 1) > 0.1::DOUBLE * (n_pages + 4) GROUP BY host),
kept AS (SELECT page_id, base.host, lines,
    list_filter(lines, lambda x: NOT list_contains(coalesce(boiler, []), x)) AS stay
  FROM base LEFT JOIN boiler USING (host))
SELECT page_id, host, len(lines)::BIGINT AS n_lines, (len(lines) - len(stay))::BIGINT AS n_dropped,
  sha256(array_to_string(stay, chr(10))) AS kept_sha256
FROM kept""",
    "op7_exact_dedup": f"""
WITH base AS (SELECT doc_id, {LOWER} AS t FROM documents),
grouped AS (SELECT t, max(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM base GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM base JOIN grouped USING (t)""",
    "op10_mix_sources": r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('17|' || coalesce(doc_id::VARCHAR, ''))[1:16] AS k
  FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS s FROM base GROUP BY source),
ranked AS (SELECT source, s, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::DOUBLE AS w
  FROM src),
level AS (SELECT *, (1.5::DOUBLE * sum(s) OVER ()
    - coalesce(sum(2.0::DOUBLE * s) OVER (ORDER BY 2.0::DOUBLE * s / w, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 2.0::DOUBLE * s / w, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS l FROM ranked),
filled AS (SELECT arg_min(l, 2.0::DOUBLE * s / w) FILTER (l * w <= 2.0::DOUBLE * s) AS l FROM level),
target AS (SELECT source, s, least(2.0::DOUBLE * s, filled.l * w) AS t FROM ranked, filled),
budget AS (SELECT *, round(t)::BIGINT AS b, CASE WHEN s > 0 THEN round(t)::BIGINT // s ELSE 0 END AS e FROM target),
rows_ AS (SELECT base.*, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS first FROM base)
SELECT doc_id, size, s AS source_size, t AS target,
  (e * size + greatest(0, least(size, b - e * s - first)))::BIGINT AS taken
FROM rows_ JOIN budget ON rows_.source IS NOT DISTINCT FROM budget.source""",
    "op11_lexical_search": f"""
WITH found AS (SELECT doc_id, regexp_extract_all({LOWER}, '{TERM}') AS t FROM documents),
item AS (SELECT item_id, unnest(list_distinct(regexp_extract_all({LOWER}, '{TERM}'))) AS term FROM benchmark),
tot AS (SELECT count(*) FILTER (len(t) > 0) AS nd, sum(len(t))::BIGINT AS l FROM found),
tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM found)
  WHERE term IN (SELECT term FROM item) GROUP BY doc_id, n, term),
df AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, tot GROUP BY term, nd),
impact AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nd) // l))) AS part
  FROM tf JOIN df USING (term), tot),
scored AS (SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM item JOIN impact USING (term)
  GROUP BY item_id, doc_id HAVING sum(part) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored QUALIFY rank <= 10""",
    "op12_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 11)) AS i,
    unnest(list_transform(range(1, len(words) - 11), lambda i: array_to_string(words[i:i + 12], ' '))) AS s FROM w),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + j AS k
  FROM (SELECT doc_id, i, unnest(range(13)) AS j FROM win JOIN least USING (s) WHERE m < doc_id)),
word AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS k, unnest(words) AS x FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS t FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op13_merkle_manifest": _merkle(),
}
