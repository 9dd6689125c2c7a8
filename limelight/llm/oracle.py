"""The queries of this package that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from .queries import LISTED_HOSTS

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _url_filter() -> str:
    unwanted = " OR ".join(f"contains(host, '{w}')" for w in LISTED_HOSTS)
    return f"""
WITH split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), {_UPPER}, {_LOWER}) AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), marked AS (
  SELECT *, CASE WHEN host <> '' THEN
      regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^(www|m)\\.', '')
      || regexp_replace(regexp_replace(path, '\\.html?$', ''), '/+$', '') END AS plain,
    CASE
      WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
  FROM split
), unwanted AS (SELECT DISTINCT plain FROM marked WHERE plain IS NOT NULL AND ({unwanted}))
SELECT page_id, host, path, rule, listed,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block' WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM (SELECT *, coalesce(plain IN (SELECT plain FROM unwanted), FALSE) AS listed FROM marked)
"""


LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_UPPER}, {_LOWER}) AS key
  FROM lines
), found AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT k.doc_id, k.line, k.place, f.key IS NOT NULL AND k.doc_id <> f.keeper AS gone
  FROM keyed k LEFT JOIN found f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

#: crc32 of an ASCII text, byte by byte and bit by bit.
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split({0}, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(
      list_prepend(xor(crc, byte), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))))"""

PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list({{'said': md5(length(role) || ':' || role || text), 'chars': length(text)}} ORDER BY place) AS turns
  FROM turns GROUP BY conv_id
), headed AS (
  SELECT o.conv_id, o.turns, coalesce(b.turns, []) AS base, {_CRC32.format("o.conv_id::VARCHAR")} % 6 AS h
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), rebuilt AS (
  SELECT conv_id, list_concat(base[1:h], turns[h + 1:]) AS seq FROM headed
), steps AS (
  SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM rebuilt
), nodes AS (
  SELECT d, list_transform(seq[1:d], lambda t: t.said) AS name, min(conv_id) AS conv_id,
    count(*) AS n_convs, min(CASE WHEN d > 0 THEN seq[d].chars ELSE 0 END) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends_sha256
  FROM steps GROUP BY d, name
), children AS (
  SELECT name[1:d - 1] AS name, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.name = c.name
), upward AS (
  SELECT name[1:unnest(range(d + 1))] AS name, (n_convs - 1) * chars AS saved,
    (n_children = 0)::INT AS leaf FROM full_nodes
), sums AS (
  SELECT name, sum(saved) AS saved, sum(leaf) AS leaves FROM upward GROUP BY name
)
SELECT n.conv_id, n.d::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  n.n_children::BIGINT AS n_children, s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens,
  n.ends_sha256
FROM full_nodes n JOIN sums s ON s.name = n.name
LEFT JOIN full_nodes p ON n.d > 0 AND p.name = n.name[1:n.d - 1]
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
  FROM (SELECT lang, unnest(string_split_regex(
    translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)
), sizes AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM pieces, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)
), f AS (
  SELECT lang, phrase, any_value(k) AS k, count(*) AS f FROM grams GROUP BY lang, phrase HAVING count(*) >= 100
), several AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1
), cuts AS (
  SELECT lang, phrase, f AS a, c, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS c FROM several)
), scored AS (
  SELECT x.lang, x.phrase, x.a, x.c, l.f AS l, r.f AS r, s.n,
    ((1000::HUGEINT * x.a * s.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts x JOIN f l ON l.lang = x.lang AND l.phrase = x.head
  JOIN f r ON r.lang = x.lang AND r.phrase = x.rest JOIN sizes s ON s.lang = x.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, f
  FROM (SELECT lang, f, w, k, size, unnest(range(1, k - size + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS size FROM several))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best b WHERE NOT EXISTS (
  SELECT 1 FROM inner_phrases i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.f >= 100 * b.a)
QUALIFY rank <= 2000
"""

FAIR_MIX = r"""
WITH sized AS (
  SELECT doc_id, source, md5(doc_id::VARCHAR) AS shuffled,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sizes
), weighed AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS weight, 2 * source_size AS most FROM placed
), levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(most) OVER (soon ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
    / (sum(weight) OVER (soon ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS here
  FROM weighed WINDOW soon AS (ORDER BY most::DOUBLE / weight, place)
), targets AS (
  SELECT source, source_size, place, least((max(here) OVER ()) * weight, most::DOUBLE) AS target FROM levels
), offered AS (
  SELECT s.doc_id, s.size, t.source_size, t.place, t.target, r, r * t.source_size + coalesce(sum(s.size) OVER (
      PARTITION BY t.place, r ORDER BY s.shuffled, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source, (SELECT unnest([0, 1]) AS r)
), served AS (
  SELECT *, greatest(0, least(size, floor(target)::BIGINT - start)) AS words FROM offered
), ordered AS (
  SELECT *, CASE WHEN words > 0 THEN coalesce(sum(words) OVER (
      ORDER BY (start + words)::DOUBLE / target, place, start
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END AS position
  FROM served WHERE words > 0
  UNION ALL SELECT *, NULL FROM served WHERE words = 0
)
SELECT doc_id, size, source_size, target, sum(words)::BIGINT AS taken, min(position)::BIGINT AS first_position
FROM ordered GROUP BY ALL
"""

ORACLE_SQL = {
    "op3_url_filter": _url_filter(), "op8_line_dedup": LINE_DEDUP, "op11_prefix_trie": PREFIX_TRIE,
    "op12_collocations": COLLOCATIONS, "op13_weighted_fair_mix": FAIR_MIX,
}
