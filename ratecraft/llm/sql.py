"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from ratecraft.llm import op08_mix as mix
from ratecraft.llm import op09_url_rules as urls

#: Words of benchmark and document texts: A-Z lower-cased, runs of digits, letters and non-ASCII.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAM = f"""
WITH item_words AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS w FROM benchmark
), wins AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS win, least(10, len(w)) AS n
  FROM item_words, range(1, 1 + len(w) - least(10, len(w)) + 1) t(i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM wins
), doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents
), grams AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM doc_words, sizes, range(1, 1 + greatest(0, len(w) - n + 1)) t(i)
), found AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN wins USING (win)
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM found, range(i, i + n) r(p) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN its s ON s.doc_id = d.doc_id
"""

_WEIGHTS = ", ".join(f"{w}.0::DOUBLE" for w in mix.WEIGHTS)
MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [{_WEIGHTS}][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mix.WEIGHTS)}] AS weight
  FROM per
), capped AS (
  SELECT *, {float(mix.MAX_REPEAT)}::DOUBLE * source_size AS cap,
         {float(mix.MAX_REPEAT)}::DOUBLE * source_size / weight AS fill FROM weighed
), levels AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE)
             - coalesce(sum(cap) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped
), level AS (SELECT arg_min(level, fill) AS level FROM levels WHERE level <= fill
), targets AS (
  SELECT source, source_size, least(cap, coalesce((SELECT level FROM level) * weight, cap)) AS target FROM capped
), rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM targets
), picked AS (
  SELECT doc_id, s.source, size, source_size, target,
         CAST(floor(rate) AS BIGINT) + CAST(
           CAST('0x' || substr(md5('{mix.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)
             / {float(16 ** 13)!r}::DOUBLE < rate - floor(rate) AS BIGINT) AS copies
  FROM sized s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM picked
"""

_RULE = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN struct_pack(rule := '{h}{p}', verdict := '{v}')"
    for h, p, v in sorted(urls.RULES, key=lambda r: -len(r[0] + r[1])))
URLS = rf"""
WITH rest AS (
  SELECT page_id, url, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id, url, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest
), ruled AS (SELECT *, CASE {_RULE} END AS fit FROM parts
), tok AS (
  SELECT DISTINCT url, unnest(list_concat(
      ['scheme=' || regexp_extract(url, '^([^:]*)://', 1)],
      list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: 'host=' || array_to_string(string_split(host, '.')[i:], '.')),
      list_transform(list_filter(string_split(path, '/'), lambda s: NOT regexp_matches(s, '^[0-9]*$')), lambda s: 'path=' || s),
      list_transform(list_filter(string_split(regexp_extract(url, '\?([^#]*)', 1), '&'), lambda s: s <> ''),
                     lambda s: 'key=' || regexp_extract(s, '^([^=]*)', 1)))) AS t
  FROM (SELECT DISTINCT url, host, path FROM parts WHERE host <> '')
), known AS (
  SELECT doc_id AS page_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id
), labelled AS (
  SELECT url, count(*) AS n, count(*) FILTER (WHERE bad) AS n_bad FROM parts JOIN known USING (page_id) GROUP BY url
), least_count AS (SELECT ceil({urls.MIN_SUPPORT} * sum(n)) AS c FROM labelled
), sets AS (
  SELECT t AS t1, t AS t2, n, n_bad FROM tok JOIN labelled USING (url)
  UNION ALL
  SELECT a.t, b.t, n, n_bad FROM tok a JOIN tok b ON a.url = b.url AND a.t < b.t JOIN labelled l ON l.url = a.url
), mined AS (
  SELECT t1, t2 FROM sets GROUP BY t1, t2
  HAVING sum(n_bad) >= (SELECT c FROM least_count) AND sum(n_bad) > 0 AND sum(n_bad) / sum(n) >= {urls.MIN_CONFIDENCE}
), hits AS (
  SELECT DISTINCT a.url FROM mined JOIN tok a ON a.t = t1 JOIN tok b ON b.t = t2 AND b.url = a.url
)
SELECT page_id, host, path, fit.rule AS rule,
       coalesce(fit.verdict, CASE WHEN url IN (SELECT url FROM hits) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

WARC = """
WITH payload AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY payload_digest) AS top FROM payload
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND place > 1 THEN top END AS refers_to
FROM placed
"""

SEARCH = f"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS w FROM documents
), sized AS (SELECT d, doc_id, w, CAST(len(w) AS HUGEINT) AS n FROM words WHERE len(w) > 0
), total AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM sized
), tf AS (
  SELECT d, t, CAST(count(*) AS HUGEINT) AS tf FROM (SELECT d, unnest(w) AS t FROM sized) GROUP BY d, t
), item_rows AS (SELECT row_number() OVER () AS i, item_id, text FROM (SELECT DISTINCT item_id, text FROM benchmark)
), item_terms AS (SELECT DISTINCT i, unnest({_WORDS}) AS t FROM item_rows
), df AS (SELECT t, count(*) AS df FROM tf WHERE t IN (SELECT t FROM item_terms) GROUP BY t
), weights AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS HUGEINT) AS wt FROM df, total
), scored AS (
  SELECT i, tf.d, CAST(sum(wt * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (t) JOIN tf USING (t) JOIN sized ON sized.d = tf.d, total GROUP BY i, tf.d
), placed AS (
  SELECT i, doc_id, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS place
  FROM scored JOIN sized USING (d) WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM placed JOIN item_rows USING (i) WHERE place <= 50
"""

NEGATIVES = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(list_transform(a.v, lambda x: CAST(x AS DOUBLE)), list_transform(b.v, lambda x: CAST(x AS DOUBLE))) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.r <> b.r AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id, br) <= 5
), negatives AS (
  SELECT p.anchor_id, p.other_id AS positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.ar, p.br ORDER BY n.score DESC, n.other_id, n.br) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON n.ar = p.ar AND NOT n.same
  WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""

ORACLE: dict[str, str] = {"op11_warc_index": WARC, "op12_treap_search": SEARCH, "op13_hard_negatives": NEGATIVES, "op7_decontam": DECONTAM, "op8_mix_sources": MIX, "op9_url_rules": URLS}
