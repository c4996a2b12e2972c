"""DuckDB statements that recompute each registered query independently.

They run on the raw parquet views (``documents``, ``embeddings`` ...) with
DuckDB's own operators (RE2 regex, list functions, recursive CTEs), so they
check the Spark plans rather than share code with them. Patterns that need
look-arounds in Java are written as CASE expressions here. Queries whose
semantics RE2 cannot express (the full normaliser) have no entry and are
tested against a brute-force Python version in ``tests/``.
"""

from __future__ import annotations

from herald import catalog as C
from herald.functions import text as TX
from herald.functions.fixed_values import GENERIC_TERMS, OTP_CONTEXT_WORDS, SIGNOFF_WORDS
from herald.operators import naming as NM
from herald.operators.density import cos_to_dist


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


SP = TX.PY_SPACE


def collapse(x: str) -> str:
    return "trim(regexp_replace(" + x + ", " + lit(SP + "+") + ", ' ', 'g'))"


def pystrip(x: str) -> str:
    return "regexp_replace(" + x + ", " + lit("^" + SP + "+|" + SP + "+$") + ", '', 'g')"


_SIGN = "|".join(SIGNOFF_WORDS)
_GEN = "|".join(GENERIC_TERMS)
RE2_SIGNOFF = r"(?i)(\b(?:" + _SIGN + r")\s*,\s*)([A-Z][A-Za-z'\-.]{1,20})\b"
RE2_GREETING = r"^(?i)([A-Z][A-Za-z'\-.]{1,20}(?:\s+[A-Z][A-Za-z'\-.]{0,20}){0,2})\s*,\s+"
RE2_SENT = r"(?i)(:\s*)([A-Za-z][A-Za-z'\-]*(?:\s+[A-Za-z][A-Za-z'\-]*){0,3})(\s+sent you\b)"
RE2_EMAIL = r"(?i)\b[A-Z0-9._%+\-]+@[A-Z0-9.\-]+\.[A-Z]{2,}\b"
RE2_TIME = r"(?i)\b(\d{1,2}):(\d{2})\s*(am|pm)\s*et\b"
RE2_GATE = r"(?i)\bgate\s*[a-zA-Z]\d{1,3}\b"
RE2_OTP = r"\b([0-9]{4,8})\b"
RE2_PHONE = r"\b\+?\d[\d\-.\s()\x{A0}]{6,}\d\b"
# Every character that ends a word stands between the marks 2 and 1 (3 after an opening, 4 before a closing
# brace, next to which no number counts), so a number can be told from its marks without looking around.
RE2_NUMBER = r"(^|\x01)([0-9]+(?:\x02[.,]\x01[0-9]+)?)(\x02|$)"
RE2_OTP_CONTEXT = r"(?i)\b(?:" + OTP_CONTEXT_WORDS + r")\b[^0-9]{0,20}\b([0-9]{4,8})\b"
RE2_URL = r"""(?i)\b((?:https?://|www\.)[^\s<>"]+|(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?:/[^\s<>"]*)?)"""

MSGS = """msgs AS (SELECT source AS originator_id, CAST(doc_id AS VARCHAR) AS message_id,
                 text AS raw_text, doc_id + 1 AS seq FROM documents)"""
MSG_COLS = "originator_id, message_id, raw_text, seq"

REGS = """regs AS (SELECT source AS business_number,
                 'Messages in ' || lang || ' sent by ' || source AS description,
                 source || ' ' || lang || ' notices' AS campaign_name,
                 'text' AS content_type, 'reply to ' || source AS call_to_action,
                 CAST(count(*) AS VARCHAR) || ' messages' AS customer_experience,
                 min(doc_id) AS seq
          FROM documents GROUP BY source, lang)"""

EMB_U = """emb_u AS (
  SELECT CASE WHEN vec_id % 100 = 7 THEN 'tiny' ELSE 'e' || (vec_id % 3) END AS originator_id,
         CAST(vec_id AS VARCHAR) AS template_hash, vec_id,
         CASE WHEN vec_id % 11 = 0 THEN -1 ELSE CAST(label AS INTEGER) END AS cluster_label,
         CAST(1 + vec_id % 4 AS BIGINT) AS w, ev.ts, dc.text AS txt,
         list_transform(embedding::DOUBLE[], lambda x: x / greatest(nrm, 1e-12)) AS v
  FROM (SELECT *, sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda y: y * y))) AS nrm
        FROM embeddings) e
  LEFT JOIN events ev ON ev.event_id = e.vec_id LEFT JOIN documents dc ON dc.doc_id = e.vec_id),
emb_l AS (SELECT * FROM emb_u WHERE cluster_label <> -1)"""

OL = "originator_id, cluster_label"


def centroid_ctes(src: str, name: str) -> str:
    """CTEs ``{name}`` (originator_id, cluster_label, c) of unit centroids over ``src`` (.., v)."""
    return f"""{name}_ex AS (SELECT {OL}, unnest(range(len(v))) AS pos, unnest(v) AS x FROM {src}),
{name}_m AS (SELECT {OL}, pos, avg(x) AS x FROM {name}_ex GROUP BY ALL),
{name}_n AS (SELECT {OL}, sqrt(sum(x * x)) AS n FROM {name}_m GROUP BY ALL),
{name} AS (SELECT {OL}, list(m.x / greatest(n.n, 1e-12) ORDER BY m.pos) AS c
           FROM {name}_m m JOIN {name}_n n USING ({OL}) GROUP BY {OL})"""


CAMPS = f"""{centroid_ctes('emb_l', 'cent')},
cnt AS (SELECT {OL}, count(*) AS prototypes_count, CAST(sum(w) AS BIGINT) AS messages_count,
               min(ts) AS window_start, max(ts) AS window_end FROM emb_l GROUP BY ALL),
camps AS (SELECT {OL}, CAST(dense_rank() OVER (PARTITION BY originator_id ORDER BY cluster_label) - 1 AS INTEGER)
                 AS row_index, 'label ' || cluster_label AS campaign_name, c, prototypes_count, messages_count,
                 window_start, window_end
          FROM cent JOIN cnt USING ({OL}))"""

EXAMPLES = f"""mem0 AS (SELECT u.template_hash, u.originator_id, u.cluster_label, k.row_index, u.w, u.txt,
                list_dot_product(u.v, k.c) AS sim FROM emb_l u JOIN camps k USING ({OL})),
ex AS (SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY {OL} ORDER BY sim DESC, template_hash) AS INTEGER)
                             AS rk FROM mem0) WHERE rk <= 5)"""

ASSIGN = f"""sc AS (SELECT u.vec_id, k.row_index, k.cluster_label, k.campaign_name,
                list_dot_product(u.v, k.c) AS score FROM emb_u u JOIN camps k USING (originator_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, row_index) AS rn
                        FROM sc) WHERE rn = 1),
asg AS (SELECT u.vec_id, u.template_hash, u.originator_id, u.w, u.ts, u.txt, u.v, b.row_index,
               b.cluster_label AS assigned_label, coalesce(b.campaign_name, '') AS campaign_name, b.score,
               CASE WHEN b.score >= {C.EMB_SIM_THRESHOLD} THEN 'Known' ELSE 'Unknown' END AS status
        FROM emb_u u LEFT JOIN best b USING (vec_id))"""

EPS = f"CAST('{cos_to_dist(C.EMB_DENSITY_MIN_COS)!r}' AS DOUBLE)"


def reach_ctes(src: str, p: str) -> str:
    """CTE ``{p}w`` (originator_id, a, b, w): mutual reachability (min_samples 2) within each sender."""
    return f"""{p}pr AS (SELECT x.originator_id, x.template_hash AS a, y.template_hash AS b,
        sqrt(greatest(2.0 - 2.0 * list_dot_product(x.v, y.v), 0.0)) AS d
        FROM {src} x JOIN {src} y ON x.originator_id = y.originator_id AND x.template_hash <> y.template_hash),
{p}core AS (SELECT originator_id, a, min(d) AS core FROM {p}pr GROUP BY ALL),
{p}w AS (SELECT r.originator_id, r.a, r.b, greatest(r.d, ca.core, cb.core) AS w
         FROM {p}pr r JOIN {p}core ca ON ca.a = r.a AND ca.originator_id = r.originator_id
         JOIN {p}core cb ON cb.a = r.b AND cb.originator_id = r.originator_id)"""


def hierarchy_ctes(src: str, p: str, size: int, epsilon: str) -> str:
    """CTE ``{p}lab`` (originator_id, id, cluster_label): exact excess of mass over ``{p}w`` of :func:`reach_ctes`.

    Prim's order of a sender's rows with the weights at which they join: a component at a
    level is a run of rows that join at no more than it, so all components are intervals.
    """
    return f"""{p}ix AS (SELECT originator_id, template_hash AS id,
        row_number() OVER (PARTITION BY originator_id ORDER BY template_hash) AS i FROM {src}),
{p}row AS (SELECT x.originator_id, x.i, list(coalesce(CAST(round(w * 1000000) AS BIGINT), 0) ORDER BY y.i) AS ws
    FROM {p}ix x JOIN {p}ix y ON x.originator_id = y.originator_id LEFT JOIN {p}w e
      ON e.originator_id = x.originator_id AND e.a = x.id AND e.b = y.id GROUP BY ALL),
{p}mat AS (SELECT originator_id, count(*) AS n, list(ws ORDER BY i) AS m FROM {p}row GROUP BY 1),
{p}prim(originator_id, pos, cur, joins, near) AS (
    SELECT originator_id, 1::BIGINT, 1::BIGINT, 4000000::BIGINT, list_concat([-1::BIGINT], m[1][2:]) FROM {p}mat
    UNION ALL
    SELECT q.originator_id, q.pos + 1, nx.j, q.near[nx.j],
           list_transform(q.near, lambda x, k: CASE WHEN k = nx.j OR x < 0 THEN -1 ELSE least(x, t.m[nx.j][k]) END)
    FROM {p}prim q JOIN {p}mat t ON t.originator_id = q.originator_id AND q.pos < t.n,
         LATERAL (SELECT list_position(q.near, list_min(list_filter(q.near, lambda x: x >= 0)))::BIGINT AS j) nx),
{p}lev AS (SELECT DISTINCT originator_id, joins AS lv FROM {p}prim WHERE pos > 1),
{p}run AS (SELECT q.originator_id, l.lv, q.pos, sum((q.joins > l.lv)::INT) OVER (
             PARTITION BY q.originator_id, l.lv ORDER BY q.pos) AS g
           FROM {p}prim q JOIN {p}lev l ON l.originator_id = q.originator_id),
{p}iv AS (SELECT originator_id, lv, min(pos) AS lo, max(pos) AS hi FROM {p}run GROUP BY originator_id, lv, g),
{p}nd AS (SELECT originator_id, lo, hi, min(lv) AS lv, hi - lo + 1 AS size FROM {p}iv
          WHERE hi - lo + 1 >= {size} GROUP BY originator_id, lo, hi),
{p}up AS (SELECT c.*, arg_min({{'lo': a.lo, 'hi': a.hi}}, a.size) AS up FROM {p}nd c LEFT JOIN {p}nd a
          ON a.originator_id = c.originator_id AND a.lo <= c.lo AND a.hi >= c.hi AND a.size > c.size GROUP BY ALL),
{p}nb AS (SELECT u.*, (SELECT count(*) FROM {p}up k WHERE k.originator_id = u.originator_id
                       AND k.up.lo = u.lo AND k.up.hi = u.hi) AS nb FROM {p}up u),
{p}ch(originator_id, clo, chi, clv, lo, hi, size, up, total) AS (
    SELECT originator_id, lo, hi, lv, lo, hi, size, up, size * 1e6::DOUBLE / greatest(lv, 1) FROM {p}nb WHERE nb <> 1
    UNION ALL
    SELECT c.originator_id, clo, chi, clv, n.lo, n.hi, n.size, n.up,
           total + (n.size - c.size) * 1e6::DOUBLE / greatest(n.lv, 1)
    FROM {p}ch c JOIN {p}nb n ON n.originator_id = c.originator_id AND n.lo = c.up.lo AND n.hi = c.up.hi AND n.nb = 1),
{p}tp AS (SELECT * FROM {p}ch QUALIFY row_number() OVER (PARTITION BY originator_id, clo, chi ORDER BY size DESC) = 1),
{p}cl AS (SELECT t.originator_id, clo, chi, n.lo AS plo, n.hi AS phi, n.lv AS ends,
                 total - coalesce(t.size * 1e6::DOUBLE / greatest(n.lv, 1), 0) AS own,
                 row_number() OVER (PARTITION BY t.originator_id ORDER BY clv, clo) AS nr
          FROM {p}tp t LEFT JOIN {p}nb n ON n.originator_id = t.originator_id AND n.lo = t.up.lo AND n.hi = t.up.hi),
{p}pa AS (SELECT c.*, q.nr AS parent, q.ends IS NULL AND q.nr IS NOT NULL AS below_root FROM {p}cl c LEFT JOIN {p}cl q
          ON q.originator_id = c.originator_id AND q.clo = c.plo AND q.chi = c.phi),
{p}kd AS (SELECT c.*, coalesce((SELECT list(k.nr) FROM {p}pa k WHERE k.originator_id = c.originator_id
                                AND k.parent = c.nr), []) AS kids FROM {p}pa c),
{p}ev(originator_id, i, vals) AS (SELECT DISTINCT originator_id, 0::BIGINT, []::DOUBLE[] FROM {p}kd
    UNION ALL
    SELECT e.originator_id, i + 1, list_append(vals, greatest(own,
        coalesce(list_sum(list_transform(kids, lambda k: vals[k])), 0))) FROM {p}ev e
    JOIN {p}kd c ON c.originator_id = e.originator_id AND c.nr = i + 1),
{p}al AS (SELECT originator_id, arg_max(vals, i) AS vals FROM {p}ev GROUP BY 1),
{p}kp AS (SELECT c.*, ends IS NOT NULL AND own >= coalesce(list_sum(list_transform(kids, lambda k: vals[k])), 0) AS keep
          FROM {p}kd c JOIN {p}al USING (originator_id)),
{p}dn(originator_id, nr, pick) AS (SELECT originator_id, nr, CASE WHEN keep THEN nr END FROM {p}kp WHERE parent IS NULL
    UNION ALL SELECT k.originator_id, k.nr, coalesce(d.pick, CASE WHEN k.keep THEN k.nr END) FROM {p}dn d
    JOIN {p}kp k ON k.originator_id = d.originator_id AND k.parent = d.nr),
{p}st(originator_id, nr) AS (SELECT DISTINCT originator_id, pick FROM {p}dn WHERE pick IS NOT NULL
    UNION ALL SELECT s.originator_id, k.parent FROM {p}st s JOIN {p}kp k ON k.originator_id = s.originator_id
      AND k.nr = s.nr WHERE k.parent IS NOT NULL AND k.ends < {epsilon} AND NOT k.below_root),
{p}fi AS (SELECT DISTINCT s.originator_id, s.nr FROM {p}st s JOIN {p}kp k ON k.originator_id = s.originator_id AND k.nr = s.nr
          WHERE k.parent IS NULL OR k.ends >= {epsilon} OR k.below_root),
{p}fl(originator_id, nr, pick) AS (SELECT k.originator_id, k.nr, f.nr FROM {p}kp k LEFT JOIN {p}fi f
        ON f.originator_id = k.originator_id AND f.nr = k.nr WHERE parent IS NULL
    UNION ALL SELECT k.originator_id, k.nr, coalesce(d.pick, f.nr) FROM {p}fl d JOIN {p}kp k
        ON k.originator_id = d.originator_id AND k.parent = d.nr
        LEFT JOIN {p}fi f ON f.originator_id = k.originator_id AND f.nr = k.nr),
{p}first AS (SELECT q.originator_id, x.id, arg_min({{'clo': c.clo, 'chi': c.chi}}, c.size) AS own FROM {p}prim q
    JOIN {p}ix x ON x.originator_id = q.originator_id AND x.i = q.cur
    JOIN {p}ch c ON c.originator_id = q.originator_id AND q.pos BETWEEN c.lo AND c.hi GROUP BY ALL),
{p}got AS (SELECT f.originator_id, f.id, l.pick FROM {p}first f JOIN {p}kp k ON k.originator_id = f.originator_id
    AND k.clo = f.own.clo AND k.chi = f.own.chi JOIN {p}fl l ON l.originator_id = k.originator_id AND l.nr = k.nr
    WHERE l.pick IS NOT NULL),
{p}num AS (SELECT originator_id, pick, CAST(dense_rank() OVER (PARTITION BY originator_id ORDER BY min(id)) - 1 AS INTEGER)
           AS cluster_label FROM {p}got GROUP BY originator_id, pick),
{p}lab AS (SELECT g.originator_id, g.id, cluster_label FROM {p}got g JOIN {p}num n USING (originator_id, pick))"""


def component_ctes(src: str, p: str, eps: str, out: str) -> str:
    """Recursive CTE and ``{out}`` (originator_id, id, comp) at one level."""
    return f"""{out}_r(originator_id, id, comp) AS (SELECT originator_id, template_hash, template_hash FROM {src}
        UNION SELECT r.originator_id, e.b, r.comp FROM {out}_r r JOIN {p}w e
              ON e.originator_id = r.originator_id AND e.a = r.id AND e.w <= {eps}),
{out} AS (SELECT originator_id, id, min(comp) AS comp FROM {out}_r GROUP BY originator_id, id)"""


def label_ctes(comp: str, out: str, size: int) -> str:
    """CTE ``{out}`` (originator_id, id, cluster_label), noise left out."""
    return f"""{out}_k AS (SELECT originator_id, comp, CAST(dense_rank() OVER (PARTITION BY originator_id ORDER BY comp) - 1
        AS INTEGER) AS cluster_label FROM (SELECT originator_id, comp FROM {comp} GROUP BY ALL HAVING count(*) >= {size})),
{out} AS (SELECT c.originator_id, c.id, k.cluster_label FROM {comp} c JOIN {out}_k k USING (originator_id, comp))"""


def stable_ctes(p: str, levels: list[float], size: int) -> str:
    """Excess-of-mass choice over component CTEs ``{p}l0`` ..: CTE ``{p}chosen`` (originator_id, lv, comp)."""
    lam = [1 / e for e in levels] + [0.5]
    out = [f"{p}n AS (SELECT originator_id, count(*) AS n FROM {p}l0 GROUP BY ALL)"]
    for i in range(len(levels)):
        up = f"(SELECT originator_id, id AS comp, comp AS parent FROM {p}l{i + 1})" if i + 1 < len(levels) else \
            "(SELECT '' AS originator_id, '' AS comp, '' AS parent WHERE false)"
        kids = f"""(SELECT originator_id, parent AS comp, count(*) AS k, sum(own) AS o, sum(sub) AS s,
                    sum(greatest(own, sub)) AS b FROM {p}t{i - 1} GROUP BY ALL)""" if i else \
            "(SELECT '' AS originator_id, '' AS comp, 0 AS k, 0.0 AS o, 0.0 AS s, 0.0 AS b WHERE false)"
        out.append(f"""{p}t{i} AS (SELECT z.originator_id, z.comp, u.parent,
          z.size * ({lam[i]!r}::DOUBLE - {lam[i + 1]!r}::DOUBLE) + CASE WHEN c.k = 1 THEN c.o ELSE 0 END AS own,
          coalesce(CASE WHEN c.k = 1 THEN c.s ELSE c.b END, 0) AS sub, z.size < n.n AS inner_node
        FROM (SELECT originator_id, comp, count(*) AS size FROM {p}l{i} GROUP BY ALL HAVING count(*) >= {size}) z
        JOIN {p}n n USING (originator_id) LEFT JOIN {up} u USING (originator_id, comp)
        LEFT JOIN {kids} c USING (originator_id, comp))""")
    for i in reversed(range(len(levels))):
        above = f"LEFT JOIN {p}s{i + 1} a ON a.originator_id = t.originator_id AND a.comp = t.parent" \
            if i + 1 < len(levels) else ""
        blocked = "coalesce(a.covered, false)" if above else "false"
        out.append(f"""{p}s{i} AS (SELECT t.originator_id, t.comp, NOT {blocked} AND t.own >= t.sub AND t.inner_node AS picked,
          {blocked} OR (t.own >= t.sub AND t.inner_node) AS covered FROM {p}t{i} t {above})""")
    picks = " UNION ALL ".join(f"SELECT originator_id, {i} AS lv, comp FROM {p}s{i} WHERE picked"
                               for i in range(len(levels)))
    out.append(f"{p}chosen AS ({picks})")
    return ",\n".join(out)


DISCOVERY = f"""gate AS (SELECT originator_id, count(*) FILTER (WHERE lower(status) <> 'known') AS nu,
                 avg(CASE WHEN lower(status) = 'known' THEN 1.0 ELSE 0.0 END) AS cov FROM asg GROUP BY 1),
unk AS (SELECT asg.* FROM asg JOIN gate USING (originator_id)
        WHERE lower(status) <> 'known' AND cov < 0.999 AND nu >= 5),
{reach_ctes('unk', 'u_')},
{component_ctes('unk', 'u_', EPS, 'u_c')},
{label_ctes('u_c', 'u_lab', C.EMB_DENSITY_MIN_SIZE)},
lab_rows AS (SELECT unk.*, u_lab.cluster_label FROM unk JOIN u_lab
             ON u_lab.originator_id = unk.originator_id AND u_lab.id = unk.template_hash),
sz AS (SELECT {OL}, count(*) AS cluster_size FROM lab_rows GROUP BY ALL HAVING count(*) >= 3),
mem AS (SELECT lab_rows.* FROM lab_rows JOIN sz USING ({OL})),
{centroid_ctes('mem', 'cent2')},
ms AS (SELECT m.vec_id, m.template_hash, m.originator_id, m.cluster_label, m.ts, m.txt, list_dot_product(m.v, c2.c) AS sim
       FROM mem m JOIN cent2 c2 USING ({OL})),
smp AS (SELECT {OL}, txt AS text_sample FROM (SELECT *, row_number() OVER (
          PARTITION BY {OL} ORDER BY sim DESC, template_hash) AS rk FROM ms) WHERE rk <= 5)"""


def url_placeholder(m: str) -> str:
    host = f"split_part(split_part(regexp_replace(trim({m}), '^(?i)https?://', ''), '/', 1), ':', 1)"
    host2 = f"(CASE WHEN starts_with(lower({host}), 'www.') THEN substr({host}, 5) ELSE {host} END)"
    low = f"lower({host2})"
    parts = f"list_filter(string_split({low}, '.'), lambda p: p <> '')"
    dom = f"(CASE WHEN len({parts}) >= 2 THEN {parts}[-2] || '.' || {parts}[-1] ELSE {low} END)"
    return f"(CASE WHEN {dom} = '' THEN '{{URL}}' ELSE '{{URL:' || {dom} || '}}' END)"


def url_rebuild(t: str, pieces: str, matches: str) -> str:
    rep = url_placeholder(f"{matches}[i]")
    return (f"(CASE WHEN len({matches}) = 0 THEN {t} ELSE {pieces}[1] || array_to_string("
            f"list_transform(range(1, len({matches}) + 1), lambda i: {rep} || {pieces}[i + 1]), '') END)")


def tfidf_names(samples: str, group: str, scope: str, text: str, out: str, max_words: int = 5,
                p: str = "") -> str:
    """SQL for the default namer over CTE ``samples`` (cols group..., text);
    the result CTE is ``{p}named``."""
    g = group
    return f"""{p}t AS (SELECT {g}, unnest(regexp_extract_all(lower({text}), '\\p{{L}}{{3,}}')) AS term FROM {samples}),
{p}tf AS (SELECT {g}, term, count(*) AS tf FROM {p}t GROUP BY ALL),
{p}dfq AS (SELECT {scope}, term, count(*) AS df FROM {p}tf GROUP BY ALL),
{p}grp AS (SELECT {scope}, count(*) AS ng FROM (SELECT DISTINCT {g} FROM {samples}) GROUP BY ALL),
{p}scr AS (SELECT x.*, x.tf * (ln((1 + ng) / (1 + df)) + 1) AS score
        FROM {p}tf x JOIN {p}dfq USING ({scope}, term) JOIN {p}grp USING ({scope})),
{p}rk AS (SELECT *, row_number() OVER (PARTITION BY {g} ORDER BY score DESC, term) AS r FROM {p}scr),
{p}nm AS (SELECT {g}, string_agg(term, ' ' ORDER BY r) AS nm FROM {p}rk WHERE r <= {max_words} GROUP BY ALL),
{p}named AS (SELECT DISTINCT {', '.join('s.' + c.strip() for c in g.split(','))}, coalesce(n.nm, '') AS {out}
          FROM {samples} s LEFT JOIN {p}nm n USING ({g}))"""


def _sql() -> dict:
    q = {}
    q["envelope_parse"] = f"WITH {MSGS} SELECT {MSG_COLS} FROM msgs"
    q["envelope_forms"] = q["envelope_parse"]
    q["dump_positions"] = (f"WITH {MSGS} SELECT message_id, nullif(raw_text, '') AS raw_text, "
                           f"row_number() OVER (ORDER BY seq) AS seq FROM msgs")
    q["extract_originator"] = (f"WITH {MSGS} SELECT {MSG_COLS} FROM msgs WHERE "
                               f"originator_id = '{C.EXTRACT_ORIGINATOR}' AND seq % {C.EXTRACT_DILUTE} = 0")
    q["bounded_scan"] = f"WITH {MSGS} SELECT {MSG_COLS} FROM msgs WHERE seq <= {C.EXTRACT_BOUND}"
    q["envelopes_csv"] = q["messages_csv"] = (
        "SELECT source AS originator_id, CAST(doc_id AS VARCHAR) AS message_id, text AS raw_text FROM documents")
    q["registrations_csv"] = (f"WITH {REGS} SELECT * REPLACE (row_number() OVER (ORDER BY seq) AS seq) FROM regs")
    q["per_originator"] = f"WITH {MSGS} SELECT {MSG_COLS} FROM msgs WHERE originator_id = '{C.EXTRACT_ORIGINATOR}'"
    q["null_text_counts"] = """SELECT source AS originator_id, count(*) AS n_messages,
       count(*) FILTER (WHERE b.text IS NULL) AS n_null_text
FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id GROUP BY 1"""
    q["thin_by_match"] = (f"WITH {MSGS}, m AS (SELECT *, row_number() OVER (PARTITION BY originator_id "
                          f"ORDER BY seq) AS rn FROM msgs) SELECT {MSG_COLS} FROM m WHERE rn % {C.THIN_EVERY} = 0")
    q["adaptive_thin"] = (f"WITH {MSGS}, c AS (SELECT originator_id, count(*) AS n FROM msgs GROUP BY 1), "
                          f"m AS (SELECT *, row_number() OVER (PARTITION BY originator_id ORDER BY seq) AS rn "
                          f"FROM msgs) SELECT {MSG_COLS} FROM m JOIN c USING (originator_id) "
                          f"WHERE rn % greatest(1, ceil(n / {C.ADAPTIVE_TARGET}.0)) = 0")
    q["dilute_factors"] = (f"WITH {MSGS} SELECT originator_id, count(*) AS n_matches, "
                           f"CAST(greatest(1, ceil(count(*) / {C.ADAPTIVE_TARGET}.0)) AS BIGINT) AS dilute "
                           f"FROM msgs GROUP BY 1")
    q["registrations"] = f"WITH {REGS} SELECT * FROM regs"
    q["originator_list"] = (f"WITH {REGS} SELECT DISTINCT business_number AS originator_id FROM regs "
                            f"WHERE business_number IS NOT NULL AND length(business_number) >= 5")
    q["registered_messages"] = (f"WITH {MSGS} SELECT {MSG_COLS} FROM msgs WHERE originator_id IN "
                                f"(SELECT source FROM documents WHERE lang = '{C.REGISTERED_LANG}')")
    q["text_column"] = ("SELECT CAST(NULL AS VARCHAR) AS originator_id, CAST(NULL AS VARCHAR) AS message_id, "
                        "text AS raw_text, item_id AS seq FROM benchmark")
    # text
    q["fold_confusables"] = (f"SELECT doc_id, translate(text, {lit(TX._FOLD_FROM)}, {lit(TX._FOLD_TO)}) "
                             f"AS folded FROM documents")
    q["collapse_whitespace"] = f"SELECT doc_id, {collapse('text')} AS collapsed FROM documents"
    q["mask_names_contacts"] = f"""WITH c AS (SELECT doc_id, {collapse('text')} AS t FROM documents),
s AS (SELECT doc_id, regexp_replace(t, {lit(RE2_SIGNOFF)}, '\\1{{NAME}}', 'g') AS t FROM c),
g AS (SELECT doc_id, CASE WHEN regexp_matches(t, {lit('^(?i)(?:' + _SIGN + r')\b')})
                          OR regexp_matches(t, {lit('^(?i)(?:' + _GEN + r')\s*,')}) THEN t
                     ELSE regexp_replace(t, {lit(RE2_GREETING)}, '{{NAME}}, ') END AS t FROM s),
n AS (SELECT doc_id, regexp_replace(t, {lit(RE2_SENT)}, '\\1{{NAME}}\\3', 'g') AS t FROM g)
SELECT doc_id, regexp_replace(t, {lit(RE2_EMAIL)}, '{{EMAIL}}', 'g') AS masked FROM n"""
    q["mask_codes"] = f"""WITH c AS (SELECT doc_id, lower({collapse('text')}) AS t FROM documents)
SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, {lit(RE2_TIME)}, '{{TIME}}', 'g'),
       {lit(RE2_GATE)}, '{{GATE}}', 'g'), {lit(RE2_OTP)}, '{{OTP}}', 'g') AS masked FROM c"""
    notice = """notice AS (SELECT p_partkey, p_partkey AS k, array_to_string(list_transform(string_split(p_name, ' '),
        lambda s: upper(s[1]) || lower(s[2:])), ' ') AS name, p_retailprice, p_size FROM part),
    t AS (SELECT p_partkey, 'Alert: ' || name || ' sent you $' || CAST(p_retailprice AS VARCHAR) || ' at ' || (k % 12 + 1) ||
        ':' || lpad(CAST(k % 60 AS VARCHAR), 2, '0') || CASE WHEN k % 2 = 0 THEN ' PM ET' ELSE 'am et' END || ', gate C' ||
        (p_size % 100) || '. Your security code is ' || (k + 1000) || '. Thanks, ' AS head, name FROM notice)"""
    q["fold_notices"] = f"WITH {notice} SELECT p_partkey, head || name AS folded FROM t"
    q["mask_notices"] = f"""WITH {notice},
x AS (SELECT p_partkey, head || name AS text, lower(head || name) AS low FROM t)
SELECT p_partkey, regexp_replace(text, {lit(RE2_SIGNOFF)}, '\\1{{NAME}}', 'g') AS signed,
       regexp_replace(text, {lit(RE2_SENT)}, '\\1{{NAME}}\\3', 'g') AS sent,
       regexp_replace(low, {lit(RE2_TIME)}, '{{TIME}}', 'g') AS timed,
       regexp_replace(low, {lit(RE2_GATE)}, '{{GATE}}', 'g') AS gated,
       regexp_matches(low, {lit(RE2_OTP_CONTEXT)}) AS has_code,
       regexp_replace(low, {lit(RE2_OTP)}, '{{OTP}}', 'g') AS coded FROM x"""
    q["mask_urls"] = f"""WITH p AS (SELECT page_id, url AS u, {collapse('html')} AS h FROM pages),
x AS (SELECT page_id, u, h, string_split_regex(u, {lit(RE2_URL)}) AS pu, regexp_extract_all(u, {lit(RE2_URL)}) AS mu,
             string_split_regex(h, {lit(RE2_URL)}) AS ph, regexp_extract_all(h, {lit(RE2_URL)}) AS mh FROM p)
SELECT page_id, {url_rebuild('u', 'pu', 'mu')} AS url_masked, {url_rebuild('h', 'ph', 'mh')} AS html_masked FROM x"""
    q["template_hash"] = "SELECT doc_id, left(sha256('0:' || text), 16) AS template_hash FROM documents"
    strip_t = pystrip("text")
    q["label_cleanup"] = f"""SELECT item_id,
  array_to_string(list_filter(regexp_split_to_array(regexp_replace({strip_t}, '[^\\p{{L}}\\p{{N}}_\\s\\-]', '', 'g'),
                  '\\s+'), lambda w: w <> '')[1:5], ' ') AS label,
  CASE WHEN length({strip_t}) > 30 THEN substr({strip_t}, 1, 27) || '...' ELSE {strip_t} END AS display_name
FROM benchmark"""
    q["dedupe_exact"] = f"""WITH m AS (SELECT source AS originator_id, CAST(doc_id AS VARCHAR) AS message_id, doc_id + 1 AS seq,
      left(sha256('0:' || lower({collapse('text')})), 16) AS template_hash FROM documents)
SELECT originator_id, template_hash, arg_min(message_id, seq) AS message_id, min(seq) AS seq,
       count(*) AS count_in_window FROM m GROUP BY ALL"""
    # vectors
    q["unit_vectors"] = (f"WITH {EMB_U} SELECT vec_id, unnest(range(len(v))) AS pos, "
                         f"round(unnest(v), 6) AS value FROM emb_u")
    q["centroids"] = (f"WITH {EMB_U}, {centroid_ctes('emb_u', 'cent')} SELECT {OL}, "
                      f"unnest(range(len(c))) AS pos, round(unnest(c), 6) AS value FROM cent")
    q["campaign_table"] = (f"WITH {EMB_U}, {CAMPS} SELECT originator_id, row_index, cluster_label, prototypes_count, "
                           f"messages_count, window_start, window_end, campaign_name FROM camps")
    q["assign"] = (f"WITH {EMB_U}, {CAMPS}, {ASSIGN} SELECT vec_id, originator_id, row_index AS "
                   f"assigned_campaign_row_index, round(score, 6) AS assigned_campaign_score, "
                   f"assigned_label AS assigned_campaign_label, campaign_name AS assigned_campaign_name, status FROM asg")
    q["assign_pruned"] = f"""WITH {EMB_U},
emb_f AS (SELECT * REPLACE (CAST(cluster_label * 10 + w AS INTEGER) AS cluster_label) FROM emb_l),
{centroid_ctes('emb_f', 'fine')},
fc AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY originator_id ORDER BY cluster_label) - 1 AS INTEGER) AS row_index
       FROM fine),
fs AS (SELECT u.vec_id, k.row_index, k.cluster_label, list_dot_product(u.v, k.c) AS score
       FROM emb_u u JOIN fc k USING (originator_id)),
fb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 12) DESC, row_index) AS rn
                      FROM fs) WHERE rn = 1)
SELECT u.vec_id, u.originator_id, b.row_index AS assigned_campaign_row_index,
       round(b.score, 6) AS assigned_campaign_score, b.cluster_label AS assigned_campaign_label,
       CASE WHEN b.score >= {C.EMB_SIM_THRESHOLD} THEN 'Known' ELSE 'Unknown' END AS status
FROM emb_u u LEFT JOIN fb b USING (vec_id)"""
    q["stream_vector_assignments"] = f"""WITH {EMB_U}, {CAMPS}, {ASSIGN}
SELECT vec_id, "copy"::INT AS "copy", originator_id, row_index AS assigned_campaign_row_index,
       round(score, 6) AS assigned_campaign_score, campaign_name AS assigned_campaign_name, status
FROM asg, (VALUES (0), (1)) c("copy") WHERE "copy" = 0 OR vec_id % 2 = 0"""
    q["stream_template_totals"] = f"""WITH {EMB_U}, {CAMPS}, {ASSIGN}
SELECT originator_id, template_hash, CASE WHEN vec_id % 2 = 0 THEN 2 ELSE 1 END::BIGINT AS messages, status FROM asg"""
    q["coverage"] = f"""WITH {EMB_U}, {CAMPS}, {ASSIGN},
cv AS (SELECT originator_id, count(*) AS n_total,
              coalesce(avg(CASE WHEN lower(status) = 'known' THEN 1.0 ELSE 0.0 END), 0.0) AS cov,
              count(*) FILTER (WHERE lower(status) <> 'known') AS n_unknown FROM asg GROUP BY 1)
SELECT originator_id, n_total, round(cov, 6) AS coverage, n_unknown,
       (cov < 0.999 AND n_unknown >= 5) AS eligible FROM cv"""
    q["windowed_coverage"] = f"""WITH {EMB_U}, {CAMPS}, {ASSIGN}
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL '1 day' AS window_end, originator_id,
       count(*) AS n_total, round(avg(CASE WHEN status = 'Known' THEN 1.0 ELSE 0.0 END), 6) AS coverage,
       count(*) FILTER (WHERE status <> 'Known') AS n_unknown
FROM asg WHERE ts IS NOT NULL GROUP BY ALL"""
    q["nearest_examples"] = f"""WITH {EMB_U}, {CAMPS}, {EXAMPLES}
SELECT originator_id, row_index AS campaign_row_index, cluster_label, rk AS rank, template_hash,
       round(sim, 6) AS sim_score FROM ex"""
    named = f"""WITH {EMB_U}, {CAMPS}, {EXAMPLES},
{tfidf_names('ex', OL, 'originator_id', 'txt', 'campaign_name', p='e_')}"""
    q["profile_campaigns"] = f"""{named}
SELECT k.originator_id, row_index, k.cluster_label, prototypes_count, messages_count, window_start, window_end,
       n.campaign_name FROM camps k JOIN e_named n USING ({OL})"""
    q["profile_examples"] = f"""{named}
SELECT ex.originator_id, row_index AS campaign_row_index, ex.cluster_label, rk AS rank, template_hash,
       round(sim, 6) AS sim_score, w AS count_in_window, n.campaign_name, CAST(length(txt) AS INTEGER) AS sample_chars
FROM ex JOIN e_named n USING ({OL})"""
    q["footprint"] = f"""{named}
SELECT k.originator_id, row_index, k.cluster_label, prototypes_count, n.campaign_name, 1.0::DOUBLE AS norm
FROM camps k JOIN e_named n USING ({OL})"""
    q["campaign_examples"] = f"""{named},
first_name AS (SELECT k.originator_id, n.campaign_name FROM camps k JOIN e_named n USING ({OL}) WHERE row_index = 0)
SELECT ex.originator_id, row_index AS campaign_row_index, rk AS rank, template_hash
FROM ex JOIN e_named n USING ({OL}) SEMI JOIN first_name f
  ON f.originator_id = ex.originator_id AND f.campaign_name = n.campaign_name WHERE txt IS NOT NULL"""
    q["neighbour_pairs"] = f"""WITH {EMB_U}
SELECT a.originator_id, a.template_hash AS a, b.template_hash AS b, round(list_dot_product(a.v, b.v), 6) AS cos
FROM emb_u a JOIN emb_u b ON a.originator_id = b.originator_id AND a.template_hash < b.template_hash
WHERE list_dot_product(a.v, b.v) >= {C.EMB_PAIR_MIN_COS}"""
    q["neighbour_recall"] = f"""WITH {EMB_U}
SELECT a.originator_id, count(*) AS n_exact, 0::BIGINT AS n_wrong, true AS recall_reached
FROM emb_u a JOIN emb_u b ON a.originator_id = b.originator_id AND a.template_hash < b.template_hash
WHERE list_dot_product(a.v, b.v) >= {C.EMB_PAIR_MIN_COS} GROUP BY 1"""
    q["density_clusters"] = f"""WITH RECURSIVE {EMB_U}, {reach_ctes('emb_u', 'd_')},
{component_ctes('emb_u', 'd_', EPS, 'd_c')}, {label_ctes('d_c', 'd_lab', C.EMB_DENSITY_MIN_SIZE)}
SELECT u.originator_id, u.template_hash, coalesce(l.cluster_label, -1) AS cluster_label
FROM emb_u u LEFT JOIN d_lab l ON l.originator_id = u.originator_id AND l.id = u.template_hash"""
    levels = sorted(cos_to_dist(c) for c in C.EMB_LADDER_COS)
    comps = ",\n".join(component_ctes("emb_u", "m_", f"CAST('{e!r}' AS DOUBLE)", f"m_l{i}")
                       for i, e in enumerate(levels))
    members = " UNION ALL ".join(f"SELECT l.originator_id, l.id, {i} AS lv, l.comp FROM m_l{i} l"
                                 for i in range(len(levels)))
    q["eom_clusters"] = f"""WITH RECURSIVE {EMB_U}, {reach_ctes('emb_u', 'm_')},
{comps}, {stable_ctes('m_', levels, C.EMB_DENSITY_MIN_SIZE)},
m_num AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY originator_id ORDER BY lv, comp) - 1 AS INTEGER)
          AS cluster_label FROM m_chosen),
m_lab AS (SELECT x.originator_id, x.id, m_num.cluster_label FROM ({members}) x
          JOIN m_num USING (originator_id, lv, comp))
SELECT u.originator_id, u.template_hash, coalesce(l.cluster_label, -1) AS cluster_label
FROM emb_u u LEFT JOIN m_lab l ON l.originator_id = u.originator_id AND l.id = u.template_hash"""
    exact = int(round(cos_to_dist(C.EMB_EXACT_MIN_COS) * 1e6))
    q["eom_exact"] = f"""WITH RECURSIVE {EMB_U}, {reach_ctes('emb_u', 'h_')},
{hierarchy_ctes('emb_u', 'h_', C.EMB_DENSITY_MIN_SIZE, exact)}
SELECT u.originator_id, u.template_hash, coalesce(l.cluster_label, -1) AS cluster_label
FROM emb_u u LEFT JOIN h_lab l ON l.originator_id = u.originator_id AND l.id = u.template_hash"""
    q["semantic_basis"] = f"""SELECT i, j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS inner_product
FROM range({C.SEMANTIC_DIM}) a(i), range({C.SEMANTIC_DIM}) b(j)"""
    q["adaptive_parameters"] = f"""WITH {EMB_U}
SELECT originator_id, CAST(greatest(5, floor(count(*) * 0.05)) AS INTEGER) AS min_cluster_size,
       CAST(greatest(3, floor(sqrt(count(*)))) AS INTEGER) AS min_samples, 2 AS given_min_samples
FROM emb_u GROUP BY 1"""
    disc = f"WITH RECURSIVE {EMB_U}, {CAMPS}, {ASSIGN}, {DISCOVERY}"
    dname = f"{disc},\n{tfidf_names('smp', OL, 'originator_id', 'text_sample', 'proposed_label', p='s_')}"
    q["unknown_for_discovery"] = f"{disc} SELECT vec_id, originator_id FROM unk"
    q["proposals"] = f"""{dname}
SELECT a.vec_id, a.status, CAST(ms.cluster_label AS INTEGER) AS proposed_cluster_id,
       CASE WHEN ms.cluster_label IS NULL THEN NULL WHEN ms.sim >= 0.6 THEN n.proposed_label
            ELSE '' END AS proposed_campaign_name,
       round(ms.sim, 6) AS proposed_campaign_score
FROM asg a LEFT JOIN ms USING (vec_id) LEFT JOIN s_named n
  ON n.originator_id = ms.originator_id AND n.cluster_label = ms.cluster_label"""
    q["proposed_clusters"] = f"""{dname}
SELECT sz.originator_id, sz.cluster_label, CAST(cluster_size AS BIGINT) AS cluster_size, n.proposed_label
FROM sz JOIN s_named n USING ({OL})"""
    q["cluster_members"] = f"""{disc}
SELECT originator_id, cluster_label AS proposed_cluster_id, template_hash, round(sim, 6) AS sim_score FROM ms"""
    q["new_campaigns"] = f"""{dname},
dt AS (SELECT {OL}, min(ts) AS s, max(ts) AS e FROM ms GROUP BY ALL)
SELECT sz.originator_id, CAST(row_number() OVER (PARTITION BY sz.originator_id ORDER BY sz.cluster_label) - 1 AS INTEGER)
         AS row_index,
       CAST(sz.cluster_label AS INTEGER) AS cluster_label, CAST(cluster_size AS BIGINT) AS proto_count,
       CAST(cluster_size AS BIGINT) AS msg_count, coalesce(s, TIMESTAMP '{C.RUN_TS}') AS date_range_start,
       coalesce(e, TIMESTAMP '{C.RUN_TS}') AS date_range_end, n.proposed_label AS campaign_name,
       'Unknown' AS status FROM sz JOIN s_named n USING ({OL}) JOIN dt USING ({OL})"""
    q["saved_proposals"], q["saved_new_campaigns"] = q["proposals"], q["new_campaigns"]
    q["merged_profile"] = (f"WITH {EMB_U}, {CAMPS} SELECT originator_id, cluster_label, row_index, prototypes_count, "
                           "messages_count, window_start, window_end, unnest(range(len(c))) AS pos, "
                           "round(unnest(c), 6) AS value FROM camps")
    q["unknown_labels"] = f"""{disc}
SELECT a.vec_id, coalesce(ms.cluster_label, -1) AS unknown_label
FROM asg a LEFT JOIN ms USING (vec_id) WHERE lower(a.status) <> 'known'"""
    q["drift_summary_labelled"] = f"""{dname},
nn AS (SELECT originator_id, row_index, sum(w) AS n_new FROM asg WHERE status = 'Known' AND row_index IS NOT NULL
       GROUP BY ALL),
rep AS (SELECT originator_id, campaign_name AS Ref_Campaign_name, CAST(prototypes_count AS BIGINT) AS "Count",
               campaign_name AS New_Cluster_name, CAST(coalesce(n_new, 0) AS BIGINT) AS New_number_assigned
        FROM camps LEFT JOIN nn USING (originator_id, row_index)
        UNION ALL
        SELECT sz.originator_id, 'NA', CAST(NULL AS BIGINT), n.proposed_label, CAST(cluster_size AS BIGINT)
        FROM sz JOIN s_named n USING ({OL}))
SELECT *, CAST(row_number() OVER (PARTITION BY originator_id ORDER BY Ref_Campaign_name = 'NA', New_Cluster_name,
       "Count" DESC NULLS LAST, New_number_assigned DESC) AS INTEGER) AS position FROM rep"""
    q["centroid_label"] = f"""WITH {EMB_U}, {CAMPS}, {ASSIGN}
SELECT vec_id, CASE WHEN 1.0 - score > {C.EMB_NOISE_DISTANCE} THEN -1 ELSE coalesce(assigned_label, -1) END AS plot_label
FROM asg"""
    q["label_histogram"] = f"WITH {EMB_U} SELECT originator_id, cluster_label, count(*) AS n FROM emb_u GROUP BY ALL"
    # naming
    q["group_names"] = f"""WITH s AS (SELECT source AS originator_id, lang, text AS text_sample FROM documents),
{tfidf_names('s', 'originator_id, lang', 'originator_id', 'text_sample', 'campaign_name')}
SELECT * FROM named"""
    for name, template in (("sample_prompts", NM.SAMPLE_PROMPT),
                           ("sample_prompts_any_language", NM.SAMPLE_PROMPT_ANY_LANGUAGE)):
        head, tail = template.split("{examples}")
        tail = tail.replace("{max_words}", "5")
        q[name] = f"""WITH {EMB_U}, {CAMPS}, {EXAMPLES},
nb AS (SELECT {OL}, rk, {pystrip('txt')} AS t FROM ex WHERE {pystrip('txt')} <> ''),
num AS (SELECT *, row_number() OVER (PARTITION BY {OL} ORDER BY rk) AS i FROM nb),
pr AS (SELECT {OL}, {lit(head)} || string_agg(CAST(i AS VARCHAR) || '. ' || t, chr(10) || chr(10) ORDER BY i)
              || {lit(tail)} AS prompt FROM num GROUP BY ALL)
SELECT g.originator_id, g.cluster_label, pr.prompt FROM (SELECT DISTINCT {OL} FROM ex) g LEFT JOIN pr USING ({OL})"""
    rh, rt = NM.REGISTRATION_PROMPT.split("{record}")
    rt = rt.replace("{max_words}", "5")
    from herald.sources.batches import REGISTRATION_COLUMNS
    rec = " || chr(10) || ".join(f"'{c}: ' || coalesce(CAST({c} AS VARCHAR), 'nan')" for c in REGISTRATION_COLUMNS)
    q["registration_prompts"] = f"WITH {REGS} SELECT business_number, seq, {lit(rh)} || {rec} || {lit(rt)} AS prompt FROM regs"
    regnames = f"""{REGS}, rs AS (SELECT business_number, seq, campaign_name || ' ' || description AS txt FROM regs),
{tfidf_names('rs', 'business_number, seq', 'business_number', 'txt', 'onboarding_name', p='r_')},
regn AS (SELECT regs.*, r_named.onboarding_name FROM regs LEFT JOIN r_named USING (business_number, seq))"""
    q["registration_names"] = f"WITH {regnames} SELECT business_number, seq, onboarding_name FROM regn"
    disc_names = f"""dn_s AS (SELECT source AS originator_id, lang, text AS text_sample FROM documents),
{tfidf_names('dn_s', 'originator_id, lang', 'originator_id', 'text_sample', 'campaign_name', p='d_')}"""
    view = f"""{regnames}, {disc_names},
ra AS (SELECT business_number AS originator_id,
              string_agg(onboarding_name, chr(10) ORDER BY seq) FILTER (WHERE onboarding_name IS NOT NULL) AS onboarding_names,
              string_agg(campaign_name, chr(10) ORDER BY seq) FILTER (WHERE campaign_name IS NOT NULL) AS registered_campaign_names
       FROM regn GROUP BY 1),
da AS (SELECT originator_id, string_agg(DISTINCT campaign_name, chr(10) ORDER BY campaign_name) AS discovered_names
       FROM d_named WHERE campaign_name IS NOT NULL GROUP BY 1)"""
    q["names_view"] = f"WITH {view} SELECT * FROM ra JOIN da USING (originator_id)"
    fg = f"""fg AS (SELECT business_number AS originator_id,
        'Registered:' || chr(10) || string_agg(CAST(i AS VARCHAR) || '. "' || onboarding_name || '"', chr(10) ORDER BY i) AS fg
        FROM (SELECT *, row_number() OVER (PARTITION BY business_number ORDER BY seq) AS i FROM regn
              WHERE onboarding_name IS NOT NULL) GROUP BY 1),
dl AS (SELECT DISTINCT originator_id, campaign_name FROM d_named WHERE campaign_name IS NOT NULL),
sg AS (SELECT originator_id, 'Found:' || chr(10) || string_agg(CAST(j AS VARCHAR) || '. ' || campaign_name, chr(10) ORDER BY j) AS sg
        FROM (SELECT *, row_number() OVER (PARTITION BY originator_id ORDER BY campaign_name) AS j FROM dl) GROUP BY 1)"""
    q["comparison_prompts"] = (f"WITH {view}, {fg} SELECT originator_id, {lit(NM.COMPARE_INSTRUCTIONS)} || chr(10) || fg "
                               f"|| chr(10) || chr(10) || sg || chr(10) AS prompt FROM ra JOIN da USING (originator_id) "
                               f"JOIN fg USING (originator_id) JOIN sg USING (originator_id)")
    similar = f"""tn AS (SELECT originator_id, 'found' AS side, campaign_name AS name FROM dl UNION
       SELECT business_number, 'told', onboarding_name FROM regn WHERE onboarding_name IS NOT NULL),
tt AS (SELECT *, unnest(list_distinct(regexp_extract_all(lower(name), '\\p{{L}}+|\\p{{N}}+'))) AS term FROM tn),
td AS (SELECT DISTINCT name, term FROM tt),
ti AS (SELECT term, 1 + ln((1 + (SELECT count(DISTINCT name) FROM td)) / (1 + count(*))::DOUBLE) AS w FROM td GROUP BY 1),
tw AS (SELECT tt.*, w, sqrt(sum(w * w) OVER (PARTITION BY originator_id, side, name)) AS norm FROM tt JOIN ti USING (term)),
tc AS (SELECT a.originator_id, a.name, b.name AS other, sum(a.w / a.norm * (b.w / b.norm)) AS cos
       FROM tw a JOIN tw b ON a.originator_id = b.originator_id AND a.term = b.term AND a.side = 'found' AND b.side = 'told'
       GROUP BY ALL),
sim AS (SELECT tn.originator_id, tn.name, coalesce(max(cos), 0.0) AS best FROM tn LEFT JOIN tc
        ON tc.originator_id = tn.originator_id AND tc.name = tn.name WHERE side = 'found' GROUP BY ALL)"""
    q["name_similarity"] = f"WITH {view}, {fg}, {similar} SELECT originator_id, name, round(best, 6) AS best FROM sim"
    verdict = f"""mis AS (SELECT originator_id, string_agg(name, chr(10) ORDER BY name) FILTER (WHERE best < 0.2) AS misfit_names,
               string_agg('- ' || name || ': unlike any registered title', chr(10) ORDER BY name)
                 FILTER (WHERE best < 0.2) AS lines FROM sim GROUP BY 1),
vd AS (SELECT originator_id AS business_number, CASE WHEN lines IS NULL THEN {lit(NM.FIT_TEXT)}
              ELSE {lit(NM.ANOMALY_TEXT)} || chr(10) || lines END AS llm_result,
              CASE WHEN lines IS NULL THEN 'ok' ELSE 'anomaly' END AS status, coalesce(misfit_names, '') AS misfit_names
       FROM mis)"""
    q["drift_verdicts"] = f"""WITH {view}, {fg}, {similar}, {verdict}
SELECT business_number, llm_result, status, CASE WHEN lower(llm_result) LIKE '%anomal%' THEN 'anomaly' ELSE 'ok' END
       AS text_status, misfit_names FROM vd"""
    gappy = """gap AS (SELECT ra.originator_id, CASE WHEN regexp_matches(ra.originator_id, 'src1?1$') THEN 'missing'
       WHEN regexp_matches(ra.originator_id, 'src1?2$') THEN 'empty' WHEN da.discovered_names IS NULL THEN 'missing'
       ELSE 'full' END AS kind FROM ra LEFT JOIN da USING (originator_id)),
old AS (SELECT DISTINCT business_number FROM regn WHERE business_number LIKE '%5'),
todo AS (SELECT originator_id FROM gap WHERE kind = 'full' AND originator_id NOT IN (SELECT business_number FROM old))"""
    # only pending senders' names count for the weights of words
    pend = similar.replace("FROM dl UNION", "FROM dl WHERE originator_id IN (SELECT originator_id FROM todo) UNION") \
        .replace("WHERE onboarding_name IS NOT NULL)", "WHERE onboarding_name IS NOT NULL AND business_number IN "
                 "(SELECT originator_id FROM todo))")
    q["pending_verdicts"] = f"""WITH {view}, {fg}, {gappy}, {pend}, {verdict},
every AS (SELECT business_number, llm_result FROM vd UNION ALL SELECT business_number, {lit(NM.FIT_TEXT)} FROM old)
SELECT business_number, llm_result, CASE WHEN lower(llm_result) LIKE '%anomal%' THEN 'anomaly' ELSE 'ok' END AS status
FROM every"""
    asked = f"""ask AS (SELECT originator_id, size % 4 = 3 AS failed, size % 4 = 1 AS odd
       FROM (SELECT originator_id, length({lit(NM.COMPARE_INSTRUCTIONS)}) + length(fg) + length(sg) + 4 AS size
             FROM todo JOIN fg USING (originator_id) JOIN sg USING (originator_id)))"""
    q["asked_verdicts"] = f"""WITH {view}, {fg}, {gappy}, {asked}
SELECT originator_id AS business_number,
       CASE WHEN failed THEN '' WHEN odd THEN {lit(NM.ANOMALY_TEXT)} ELSE {lit(NM.FIT_TEXT)} END AS llm_result,
       CASE WHEN failed THEN NULL WHEN odd THEN 'anomaly' ELSE 'ok' END AS status, failed FROM ask"""
    q["resumed_answers"] = q["asked_verdicts"]
    q["run_tally"] = f"""WITH {view}, {fg}, {gappy}, {asked}
SELECT CASE WHEN gap.originator_id IN (SELECT business_number FROM old) THEN 'cached' WHEN kind = 'missing' THEN 'missing'
       WHEN kind = 'empty' THEN 'empty' WHEN ask.failed THEN 'errors' ELSE 'prepared' END AS outcome, count(*) AS n
FROM gap LEFT JOIN ask USING (originator_id) GROUP BY 1"""
    q["windowed_event_counts"] = ("SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL '1 day' "
                                  "AS window_end, event_type AS originator_id, left(sha256('0:' || props), 16) "
                                  "AS template_hash, count(*) AS count_in_window FROM events GROUP BY ALL")
    ct = collapse("text")
    phones = f"regexp_extract_all(t, {lit(RE2_PHONE)})"
    digits = "len(regexp_extract_all(p, '[0-9]')) >= 7"
    q["text_masks"] = f"""WITH c AS (SELECT doc_id, text, {ct} AS t FROM documents),
ch AS (SELECT doc_id, unnest(string_split(text, '')) AS c, generate_subscripts(string_split(text, ''), 1) AS i FROM documents),
st AS (SELECT *, c IS DISTINCT FROM lag(c) OVER (PARTITION BY doc_id ORDER BY i) AS opens FROM ch),
rn AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM st),
ln AS (SELECT doc_id, run, any_value(c) AS c, count(*) AS n FROM rn GROUP BY ALL),
rp AS (SELECT doc_id, CAST(sum(CASE WHEN c IN (chr(10), chr(13)) THEN n ELSE least(n, 2) END) AS INTEGER) AS n_after_repeats
       FROM ln GROUP BY 1),
ph AS (SELECT doc_id, text, t, {phones} AS ps, string_split_regex(t, {lit(RE2_PHONE)}) AS pieces FROM c)
SELECT doc_id, length(text) AS n_chars, n_after_repeats,
       pieces[1] || array_to_string(list_transform(range(1, len(ps) + 1), lambda i:
         (CASE WHEN len(regexp_extract_all(ps[i], '[0-9]')) >= 7 THEN '{{PHONE}}' ELSE ps[i] END) || pieces[i + 1]), '')
         AS phones_masked,
       regexp_replace(regexp_replace(replace(replace(regexp_replace(t, '([^\\p{{L}}\\p{{N}}_{{}}])', chr(2) || '\\1' || chr(1), 'g'),
           '{{', chr(2) || '{{' || chr(3)), '}}', chr(4) || '}}' || chr(1)),
         {lit(RE2_NUMBER)}, '\\1{{NUM}}\\3', 'g'), '[\\x01-\\x04]', '', 'g') AS numbers_masked,
       regexp_matches(text, {lit(RE2_EMAIL)}) AS has_email
FROM ph JOIN rp USING (doc_id)"""
    q["text_predicates"] = f"""WITH c AS (SELECT doc_id, text, {ct} AS t FROM documents)
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, regexp_matches(t, {lit(RE2_EMAIL)}) AS has_email,
       len(list_filter({phones}, lambda p: {digits})) > 0 AS phone_changed,
       CAST(len(regexp_extract_all(t, {lit(RE2_URL)})) AS INTEGER) AS url_count,
       regexp_matches(lower(t), {lit(RE2_OTP_CONTEXT)}) AS has_otp_context FROM c"""
    # streams: a window is out once the largest time less the delay has passed its end
    q["stream_event_counts"] = q["windowed_event_counts"].replace(
        "GROUP BY ALL", "WHERE date_trunc('day', ts) + INTERVAL '1 day' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events) "
        "GROUP BY ALL")
    q["stream_coverage"] = """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL '1 day' AS window_end,
       event_type AS originator_id, count(*) AS n_total, round(avg(CASE WHEN value >= 5 THEN 1.0 ELSE 0.0 END), 6) AS coverage,
       count(*) FILTER (WHERE NOT value >= 5) AS n_unknown FROM events
WHERE date_trunc('day', ts) + INTERVAL '1 day' <= (SELECT max(ts) - INTERVAL '1 hour' FROM events) GROUP BY ALL"""
    return q


ORACLE = _sql()
