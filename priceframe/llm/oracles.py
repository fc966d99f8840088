"""DuckDB SQL of those queries that SQL can express; written as plain joins over all windows, shingles or pairs."""

from __future__ import annotations

from . import line_dedup, mixing

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOW_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

SUBSTRING = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
w AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 34], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM d)),
twice AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM w JOIN twice USING (h)),
words AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS word FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

NEAR = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_LOW_WORDS} AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, md5(array_to_string(ws[i : i + 4], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
sym AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, b.y FROM reach r JOIN sym b ON r.y = b.x),
root AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM documents JOIN root USING (doc_id) LEFT JOIN n USING (doc_id)
"""

CONTAMINATION = f"""
WITH b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_ALNUM} AS ws FROM benchmark),
bw AS MATERIALIZED (SELECT item, k, array_to_string(ws[i : i + k - 1], ' ') AS win FROM (SELECT item, ws, least(13, len(ws)) AS k, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
d AS MATERIALIZED (SELECT doc_id, {_ALNUM} AS ws FROM documents),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') AS win FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw))),
hits AS MATERIALIZED (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

VECTORS = """
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
sym AS MATERIALIZED (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, b.y FROM reach r JOIN sym b ON r.y = b.x),
root AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
n AS (SELECT x AS vec_id, count(*) AS n FROM sym GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM root LEFT JOIN n USING (vec_id)
"""

BYTES = """
WITH d AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT doc_id, i, hash(win) AS a, hash(win || 'x') AS b FROM (SELECT doc_id, i, substr(h, 2 * i + 1, 800) AS win FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 399)) AS i FROM d WHERE len(h) >= 800))),
twice AS (SELECT a, b FROM w GROUP BY a, b HAVING count(*) > 1),
hit AS (SELECT doc_id, i, lag(i) OVER p AS before FROM w SEMI JOIN twice USING (a, b) WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
marked AS (SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM hit),
spans AS MATERIALIZED (SELECT doc_id, span, min(i) AS s, max(i) + 400 AS e FROM marked GROUP BY doc_id, span),
pieces AS (SELECT doc_id, span, substr(h, 2 * coalesce(lag(e) OVER p, 0) + 1, 2 * (s - coalesce(lag(e) OVER p, 0))) AS piece FROM spans JOIN d USING (doc_id) WINDOW p AS (PARTITION BY doc_id ORDER BY span)),
sums AS (SELECT doc_id, count(*) AS n_spans, sum(e - s) AS n, max(e) AS last FROM spans GROUP BY doc_id),
heads AS (SELECT doc_id, string_agg(piece, '' ORDER BY span) AS head FROM pieces GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN heads USING (doc_id)
"""

#: A payload's digest: 160 bits, five to a letter.
_BITS = "list_aggregate(list_transform(string_split(sha1(encode(coalesce(html, ''))), ''), lambda c: right(bin(('0x' || c)::INT + 16), 4)), 'string_agg', '')"
PAGES = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, {_BITS} AS bits FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p)
SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
  list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ('0b' || substr(bits, 5 * k + 1, 5))::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM f
"""

PHRASES = rf"""
WITH p AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
g AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k)),
c AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
cand AS MATERIALIZED (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k > 1 AND f >= 30),
cuts AS (SELECT lang, phrase, a, cut, array_to_string(ws[1 : cut], ' ') AS head, array_to_string(ws[cut + 1 :], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)),
scored AS (SELECT cuts.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score FROM cuts JOIN c x ON x.lang = cuts.lang AND x.phrase = head JOIN c y ON y.lang = cuts.lang AND y.phrase = tail),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, array_to_string(ws[i : i + s - 1], ' ') AS phrase, a FROM (SELECT lang, ws, a, s, unnest(range(1, k - s + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS s FROM cand))),
cover AS (SELECT lang, phrase, max(a) AS longer FROM inner_ GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN cover USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

FILTERS = rf"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, {_WORDS} AS ws FROM documents),
d AS (SELECT doc_id, part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b, 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x) AS c,
  regexp_matches(x, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY x), false) AS e FROM t),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS MATERIALIZED (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS fails,
  count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM s p, s q, s r, s, s t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
m AS (SELECT f.*, filter_order, list_min(list_transform(string_split(fails, ''), lambda z: instr(filter_order, z))) AS first_fail FROM f, o),
k AS (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM m),
z AS (SELECT part, filter_order, step, sum(CASE WHEN fails = '' OR first_fail > step THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN fails <> '' AND first_fail = step THEN n ELSE 0 END)::BIGINT AS removed,
  sum(CASE WHEN first_fail < step AND contains(fails, substr(filter_order, step, 1)) AND fails <> '' THEN n ELSE 0 END)::BIGINT AS redundant,
  sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END)::BIGINT AS unique_fails,
  sum(CASE WHEN fails <> '' AND first_fail = step THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN fails <> '' AND first_fail = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost FROM k GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1))::BIGINT AS shapley FROM z
"""

ORACLE_SQL = {
    "op3_substring_dedup": SUBSTRING,
    "op4_line_dedup": line_dedup.ORACLE_SQL,
    "op5_embedding_dedup": VECTORS,
    "op6_warc": PAGES,
    "op7_minhash_dedup": NEAR,
    "op8_mixing": mixing.ORACLE_SQL,
    "op9_suffix_dedup": BYTES,
    "op10_decontaminate": CONTAMINATION,
    "op11_collocations": PHRASES,
    "op12_filter_audit": FILTERS,
}
