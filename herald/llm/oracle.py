"""DuckDB statements for the operators that SQL can express.

The others rest on XXH64, Aho-Corasick, tokenizers or trained models; tests/llm holds
them against brute-force versions.
"""

from __future__ import annotations

from herald.llm.license_scan import FILE_SHARE, STOP_WORDS, THRESHOLD, TOKEN, template_terms
from herald.llm.quality_rules import POLICIES, RULES, mask

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SOURCE_MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         (('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))), 1, 13)
          )::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nr
      FROM d GROUP BY source),
w AS (SELECT *, ([5, 2, 1][(nr - 1) % 3 + 1])::DOUBLE AS weight, (3 * source_size)::DOUBLE AS cap FROM s),
t AS (SELECT *, row_number() OVER o AS rk,
             ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(cap) OVER (
                ORDER BY cap / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY cap / weight, nr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS t
      FROM w WINDOW o AS (ORDER BY cap / weight, nr)),
g AS (SELECT *, least(cap, weight * (SELECT arg_min(t, rk) FROM t WHERE cap >= weight * t)) AS target FROM t),
q AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM g),
r AS (SELECT *, floor(ratio)::BIGINT AS certain, ratio - floor(ratio) AS fraction,
             target - floor(ratio) * source_size AS quota FROM q),
p AS (SELECT d.doc_id, d.source, d.size, source_size, target, certain, quota,
             CASE WHEN fraction > 0 AND size > 0 THEN u / (1 - u) * (1 - fraction) / fraction END AS place
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
c AS (SELECT *, CASE WHEN place IS NOT NULL THEN
               sum(CASE WHEN place IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY place NULLS LAST,
                 doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS reached FROM p),
m AS (SELECT source, coalesce(max(reached) FILTER (WHERE reached <= quota), 0) AS got FROM c GROUP BY source),
x AS (SELECT c.*, m.got, abs(quota - got - size) AS gap,
             place IS NOT NULL AND reached > quota AND abs(quota - got - size) < quota - got AS may_close
      FROM c JOIN m ON c.source IS NOT DISTINCT FROM m.source),
y AS (SELECT *, may_close AND row_number() OVER (PARTITION BY source, may_close
                                                  ORDER BY gap, place, doc_id, size) = 1 AS closes FROM x),
z AS (SELECT *, certain + (coalesce(reached <= quota, false) OR closes)::BIGINT AS copies FROM y)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM z
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, line, pos, o.key IS NOT NULL AND k.doc_id <> keeper AS gone FROM k LEFT JOIN o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

_BITS = " + ".join(f"CASE WHEN {rule} THEN {1 << bit} ELSE 0 END" for bit, rule in enumerate(RULES.values()))
_LEDGER = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS ls FROM documents),
i AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
             unnest(list_transform(range(1, len(ws) - 1),
                                   lambda j: ws[j] || ' ' || ws[j + 1] || ' ' || ws[j + 2])) AS w3 FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w3) AS n FROM i),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM g WHERE n > 1) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_text_lines,
             length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS n_capitals,
             length(regexp_replace(t, '[^A-Za-z]+', '', 'g')) AS n_letters,
             length(regexp_replace(t, '[^!]+', '', 'g')) AS n_exclamations
      FROM w LEFT JOIN c USING (doc_id)),
b AS (SELECT *, ({_BITS})::BIGINT AS fail_bits FROM m)"""
QUALITY_RULES = rf"""{_LEDGER}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {mask(POLICIES['base'])}) <> 0 AS base_failed, (fail_bits & {mask(POLICIES['v2'])}) = 0 AS kept,
       fail_bits
FROM b
"""

_CASES = ", ".join(f"('{policy}', '{rule}', {mask(rules)}, {mask([rule])})"
                   for policy, rules in POLICIES.items() for rule in rules)
QUALITY_ABLATION = rf"""{_LEDGER},
c2(policy, rule, pm, rm) AS (VALUES {_CASES})
SELECT policy, rule, count(*) FILTER (WHERE fail_bits & pm <> 0) AS dropped,
       count(*) FILTER (WHERE fail_bits & rm <> 0) AS failing,
       count(*) FILTER (WHERE fail_bits & pm = rm) AS dropped_by_it_alone
FROM b, c2 GROUP BY policy, rule
"""

_TEMPLATES = ", ".join(f"('{template}', '{term}', {n})" for template, term, n in template_terms())
_STOPS = ", ".join(f"'{w}'" for w in sorted(STOP_WORDS))
LICENSE_SCAN = rf"""
WITH tt(template, term, n) AS (VALUES {_TEMPLATES}),
d AS (SELECT doc_id, concat_ws('/', source, lang, doc_id::VARCHAR) AS path, coalesce(text, '') AS t,
             regexp_extract_all(lower(coalesce(text, '')), '{TOKEN}') AS ts FROM documents),
v AS (SELECT DISTINCT term FROM tt),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM (SELECT doc_id, unnest(ts) AS term FROM d)
       WHERE term IN (SELECT term FROM v) GROUP BY term),
idf AS (SELECT v.term, 1 + ln((1 + (SELECT count(*) FROM d)) / (1 + coalesce(df, 0))::DOUBLE) AS idf
        FROM v LEFT JOIN df USING (term)),
ll AS (SELECT doc_id, string_split(t, chr(10)) AS ls FROM d),
l AS (SELECT doc_id, unnest(ls) AS body, generate_subscripts(ls, 1) - 1 AS line FROM ll),
k AS (SELECT doc_id, line, unnest(regexp_extract_all(lower(body), '{TOKEN}')) AS term FROM l),
telling AS (SELECT DISTINCT doc_id, line FROM k WHERE term IN (SELECT term FROM v WHERE term NOT IN ({_STOPS}))),
tf AS (SELECT doc_id, line, term, count(*) AS tf FROM k SEMI JOIN telling USING (doc_id, line) GROUP BY ALL),
wt AS (SELECT tf.*, tf * coalesce(idf, 1 + ln(1 + (SELECT count(*) FROM d))) AS w FROM tf LEFT JOIN idf USING (term)),
nm AS (SELECT doc_id, line, sqrt(sum(w * w)) AS norm, sum(tf) AS words FROM wt GROUP BY ALL),
tw AS (SELECT template, term, n * idf AS tw FROM tt JOIN idf USING (term)),
tn AS (SELECT template, sqrt(sum(tw * tw)) AS tnorm FROM tw GROUP BY template),
sc AS (SELECT doc_id, line, template, words, round(sum(w * tw) / (any_value(norm) * any_value(tnorm)), 6) AS score
       FROM wt JOIN tw USING (term) JOIN nm USING (doc_id, line) JOIN tn USING (template) GROUP BY ALL),
ma AS (SELECT * FROM sc WHERE score >= {THRESHOLD}
       QUALIFY row_number() OVER (PARTITION BY doc_id, line ORDER BY score DESC, template) = 1),
ow AS (SELECT doc_id, min(struct_pack(low := -score, line := line, template := template)) AS m, sum(words) AS lw
       FROM ma GROUP BY doc_id),
f AS (SELECT d.doc_id, path, regexp_replace(path, '/?[^/]*$', '') AS dir, split_part(m.template, '#', 1) AS own,
             -m.low AS score, m.line AS line, coalesce(lw >= {FILE_SHARE} * len(ts), false) AS licence_file
      FROM d LEFT JOIN ow USING (doc_id)),
sp AS (SELECT dir AS from_dir, min(struct_pack(low := -score, own := own)).own AS license FROM f
       WHERE licence_file GROUP BY dir),
an AS (SELECT DISTINCT dir, parts, unnest(range(0, len(parts) + 1)) AS up
       FROM (SELECT DISTINCT dir, CASE WHEN dir = '' THEN [] ELSE string_split(dir, '/') END AS parts FROM f)),
st AS (SELECT dir, up, array_to_string(parts[1:len(parts) - up], '/') AS from_dir FROM an),
ih AS (SELECT dir, min(struct_pack(up := up, license := license, from_dir := from_dir)) AS m
       FROM st JOIN sp USING (from_dir) GROUP BY dir)
SELECT doc_id, path, coalesce(own, m.license) AS license,
       CASE WHEN own IS NOT NULL THEN 'header' WHEN m IS NOT NULL THEN 'inherited' ELSE 'none' END AS how,
       score, line::INT AS line, CASE WHEN own IS NULL AND m IS NOT NULL THEN m.from_dir END AS from_dir, licence_file
FROM f LEFT JOIN ih USING (dir)
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, (CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END)::BIGINT AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same,
             list_dot_product(a.q, r.q)::BIGINT AS score
      FROM v a, v r WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.*, id AS negative_id, score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank
      FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
       AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

WARC = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""

# CRC-32 bit by bit: DuckDB has no function for it
_CRC = """xor(list_reduce([4294967295::BIGINT] || flatten(list_transform(string_split(conv_id::VARCHAR, ''),
  lambda ch: list_transform(range(8), lambda k: (ascii(ch) >> k) & 1))),
  lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""
PREFIX_TRIE = rf"""
WITH t AS (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
                  len({WORDS})::BIGINT AS words FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) AS pos FROM t),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM o),
r AS (SELECT c.conv_id, 0 AS part, pos, key, words FROM c JOIN o ON o.conv_id = c.base AND pos <= h
      UNION ALL SELECT c.conv_id, 1, pos, key, words FROM c JOIN o ON o.conv_id = c.conv_id AND pos > h),
s AS (SELECT conv_id, row_number() OVER w AS depth, words, list(key) OVER (w ROWS UNBOUNDED PRECEDING) AS path
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
p AS (SELECT conv_id, depth::BIGINT AS depth, words, sha256(array_to_string(path, ',')) AS node,
             CASE WHEN depth = 1 THEN 'root' ELSE sha256(array_to_string(path[:depth - 1], ',')) END AS parent FROM s
      UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM c),
n AS (SELECT node, min(parent) AS parent, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             min(words) AS words FROM p GROUP BY node),
k AS (SELECT parent, count(*) AS n_children FROM n GROUP BY parent),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k ON k.parent = n.node),
a AS (SELECT p.node, sum((m.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum((n_convs - 1) * m.words)::BIGINT AS saved_tokens
      FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY p.node),
e AS (SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
      FROM (SELECT conv_id, arg_max(node, depth) AS node FROM p GROUP BY conv_id) GROUP BY node)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens,
       coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM m LEFT JOIN m u ON u.node = m.parent JOIN a ON a.node = m.node LEFT JOIN e ON e.node = m.node
"""

ORACLE: dict[str, str] = {
    "op2_source_mixing": SOURCE_MIXING,
    "op3_license_scan": LICENSE_SCAN,
    "op4_line_dedup": LINE_DEDUP,
    "op8_quality_rules": QUALITY_RULES,
    "quality_rule_ablation": QUALITY_ABLATION,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_warc": WARC,
    "op13_prefix_trie": PREFIX_TRIE,
}
