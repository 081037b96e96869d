"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from tallyproof.llm.license_scan import TEMPLATES

OP2 = r"""
WITH words AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents
), starts AS (
  SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS i FROM words WHERE len(w) >= 13
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM starts
), firsts AS (
  SELECT s, min(doc_id) AS first_doc FROM windows GROUP BY s
), covered AS (
  SELECT DISTINCT doc_id, i + k AS p
  FROM windows JOIN firsts USING (s), generate_series(0, 12) AS t(k) WHERE first_doc < doc_id
), gone AS (
  SELECT doc_id, list(p) AS ps FROM covered GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE
         [w[i] FOR i IN generate_series(1, len(w)) IF NOT list_contains(ps, i)] END, ' '), '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

OP6 = r"""
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents
), starts AS (
  SELECT doc_id, h, unnest(generate_series(1, n - 99)) AS i FROM bytes WHERE n >= 100
), windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i - 1, 200)) AS s FROM starts
), firsts AS (
  SELECT s, min({'d': doc_id, 'i': i}) AS f FROM windows GROUP BY s HAVING count(*) > 1
), repeated AS (
  SELECT doc_id, i FROM windows JOIN firsts USING (s) WHERE f <> {'d': doc_id, 'i': i}
), steps AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER w + 100 THEN 0 ELSE 1 END AS opens FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), runs AS (
  SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM steps
), spans AS (
  SELECT doc_id, min(i) AS b, max(i) + 100 AS e FROM runs GROUP BY doc_id, run
), gaps AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 1) AS a FROM spans
), cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(e - b) AS n_removed, max(e) AS last,
         string_agg(substr(h, 2 * a - 1, 2 * (b - a)), '' ORDER BY b) AS head
  FROM gaps JOIN bytes USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE head || substr(h, 2 * last - 1) END)) AS kept_sha256
FROM bytes LEFT JOIN cut USING (doc_id)
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), test AS (
  SELECT DISTINCT item_id, len(w[i:i + 9]) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM b WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT n FROM test
), train AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
), hits AS (
  SELECT doc_id, item_id, i, n FROM train JOIN test USING (n, s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _shared(level: str, parent: str, path: str, budgets: str, weight: str) -> str:
    """One level of the tree: children of equal budget, in the order in which they are filled."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""{level}0 AS (
  SELECT {path}, sum(cap) AS cap, any_value(budget) AS budget, any_value({weight}) AS weight FROM {budgets} GROUP BY {path}
), {level}1 AS (
  SELECT *, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM {level}0 WINDOW w AS ({by} ORDER BY CAST(cap AS DOUBLE) / weight, {level})
), {level}2 AS (
  SELECT *, cap * weights <= weight * (budget - before) AS filled FROM {level}1
), {level}3 AS (
  SELECT *, budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}) AS rest, sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by}) AS open FROM {level}2
), {level}4 AS (
  SELECT {path}, CAST(CASE WHEN filled THEN cap WHEN rest <= 0 THEN 0 ELSE least(cap, (weight * rest) // open) END AS BIGINT) AS given FROM {level}3
)"""


_MIXED = ", ".join([
    _shared("domain", "", "domain", "(SELECT *, total * 3 // 5 AS budget FROM leaves, (SELECT sum(tokens) AS total FROM leaves))",
            "CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END"),
    _shared("lang", "domain", "domain, lang", "(SELECT leaves.*, given AS budget FROM leaves JOIN domain4 USING (domain))",
            "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END"),
    _shared("source", "domain, lang", "domain, lang, source", "(SELECT leaves.*, given AS budget FROM leaves JOIN lang4 USING (domain, lang))", "1"),
])
OP10 = r"""
WITH docs AS (
  SELECT doc_id, coalesce('domain' || CAST(TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) % 4 AS VARCHAR), '') AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(2 * sum(n_tokens) AS BIGINT) AS cap FROM docs WHERE n_tokens > 0 GROUP BY ALL
), """ + _MIXED + r""", epochs AS (
  SELECT domain, lang, source, given // tokens AS whole, given % tokens AS more FROM source4 JOIN leaves USING (domain, lang, source)
), ordered AS (
  SELECT docs.*, whole, more, md5('7:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM docs LEFT JOIN epochs USING (domain, lang, source)
), placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) - n_tokens AS ahead FROM ordered
)
SELECT doc_id, domain, lang, source, n_tokens,
       CAST(CASE WHEN n_tokens = 0 THEN 0 ELSE whole + CASE WHEN more > ahead THEN 1 ELSE 0 END END AS BIGINT) AS copies
FROM placed
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
OP8 = (
    "WITH templates(template_id, license, text) AS (VALUES "
    + ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))
    + f"""), t AS (
  SELECT template_id, license, {_WORDS} AS w FROM templates
), ts AS (
  SELECT DISTINCT template_id, license, len(w) AS n, len(w) - 4 AS total, array_to_string(w[k:k + 4], ' ') AS s
  FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS k FROM t)
), tn AS (
  SELECT template_id, count(*) AS m FROM ts GROUP BY 1
), d AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), ds AS (
  SELECT doc_id, p - 1 AS p, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS p FROM d WHERE len(w) > 4)
), hits AS (
  SELECT doc_id, template_id, license, n, p, s FROM ds JOIN ts USING (s)
), windows AS (
  SELECT DISTINCT doc_id, template_id, n, p // 4 * 4 AS i FROM hits
), found AS (
  SELECT w.doc_id, w.template_id, w.i, count(DISTINCT h.s) AS c
  FROM windows w JOIN hits h ON h.doc_id = w.doc_id AND h.template_id = w.template_id AND h.p >= greatest(w.i - w.n, 0) AND h.p + 5 <= w.i + 8 + w.n
  GROUP BY ALL
), kept AS (
  SELECT DISTINCT doc_id, template_id, license FROM found JOIN tn USING (template_id) JOIN (SELECT DISTINCT template_id, license FROM t) USING (template_id) WHERE c >= 0.8 * m
), by_doc AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, count(DISTINCT template_id) AS n FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(licenses, '') AS licenses, CAST(coalesce(n, 0) AS BIGINT) AS n_templates FROM documents LEFT JOIN by_doc USING (doc_id)
"""
)

OP13 = r"""
WITH split AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM split
), starts AS (
  SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM pieces
), sizes(k) AS (
  VALUES (1), (2), (3), (4)
), f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM starts, sizes WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30
), cuts AS (
  SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM candidates
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, (2000000::HUGEINT * c.a) // (x.f + y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), ends AS (
  SELECT *, unnest(generate_series(1, k)) AS i FROM candidates
), inside AS (
  SELECT lang, array_to_string(w[i:i + s.k - 1], ' ') AS phrase, max(a) AS most
  FROM ends e, sizes s WHERE s.k > 1 AND s.k < e.k AND i + s.k - 1 <= e.k GROUP BY ALL
), kept AS (
  SELECT l.* FROM lowest l LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100 * most < 80 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op2_superkmer_repeats": OP2,
    "op6_merged_bwt_repeats": OP6,
    "op7_positional_index": OP7,
    "op8_license_bands": OP8,
    "op10_hierarchical_mix": OP10,
    "op13_setm_phrases": OP13,
}
