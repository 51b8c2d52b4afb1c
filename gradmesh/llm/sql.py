"""DuckDB SQL of the corpus queries that SQL can express."""

from gradmesh.llm import url_templates as U
from gradmesh.llm.template_leaks import PUNCTUATION, UNITS

RULES = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
win AS (SELECT doc_id, i, list_aggregate(ws[i:i + 4], 'string_agg', ' ') AS g FROM d, unnest(range(1, len(ws) - 3)) AS r(i)),
rep AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep, range(5) AS r(k) WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
         len(ls) AS n_lines,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper_chars,
         length(regexp_replace(t, '[^a-z]', '', 'g')) AS lower_chars
  FROM d LEFT JOIN cov ON d.doc_id IS NOT DISTINCT FROM cov.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR n_symbols * 10 > n_words
            OR upper_chars > lower_chars OR n_dup_lines * 10 > n_lines * 3) AS kept
FROM m
"""

LINES = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents WHERE text IS NOT NULL),
t AS (SELECT doc_id, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM l),
w AS (
  SELECT doc_id, pos AS a, lead(pos, 2) OVER d AS b, concat_ws(chr(10), x, lead(x) OVER d, lead(x, 2) OVER d) AS k
  FROM t WHERE x <> '' AND doc_id IS NOT NULL WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
later AS (SELECT doc_id, a, b FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, a) AS n FROM w WHERE b IS NOT NULL) WHERE n > 1),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM l JOIN later ON l.doc_id = later.doc_id AND l.pos BETWEEN later.a AND later.b),
kept AS (
  SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.pos) AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos WHERE gone.pos IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, CAST(length(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END) AS BIGINT) AS n_chars,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

_UNIT_LIST = ", ".join(f"'{u}'" for u in UNITS)
_PUNCTUATION = PUNCTUATION.replace("'", "''")


def _template_windows(id_col: str, source: str) -> str:
    """Windows of five template words: id, place of the first, template, values of its slots."""
    return rf"""
  SELECT id, row_number() OVER d - 1 AS pos, count(*) OVER five AS n,
         string_agg(slot, ' ') OVER five AS h,
         list(CASE WHEN regexp_matches(slot, '[\x01-\x03]') THEN val END) OVER five AS vals,
         list(slot) OVER five AS slots
  FROM (
    SELECT id, i, val, CASE WHEN val IN ({_UNIT_LIST}) AND suffix(lag(num) OVER (PARTITION BY id ORDER BY i), chr(2)) THEN chr(3) ELSE num END AS slot
    FROM (
      SELECT id, i, CASE WHEN name THEN chr(1) || x ELSE x END AS val, CASE WHEN name THEN chr(1) ELSE regexp_replace(x, '[0-9]+', chr(2), 'g') END AS num
      FROM (
        SELECT id, i, lower(translate(w, '{_PUNCTUATION}', '')) AS x,
               coalesce(regexp_matches(w, '^\p{{Lu}}\p{{Ll}}') AND regexp_matches(lag(w) OVER (PARTITION BY id ORDER BY i), '[\p{{Ll}},;]$'), false) AS name
        FROM (SELECT {id_col} AS id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
              FROM (SELECT {id_col}, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]') AS ws FROM {source} WHERE {id_col} IS NOT NULL)))
      WHERE x <> ''))
  WINDOW d AS (PARTITION BY id ORDER BY i), five AS (PARTITION BY id ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)"""


LEAKS = rf"""
WITH b AS (
  SELECT id, pos, h, list_filter(vals, lambda v: v IS NOT NULL) AS vals
  FROM ({_template_windows("item_id", "benchmark")})
  WHERE n = 5 AND len(list_distinct(list_filter(slots, lambda v: NOT regexp_matches(v, '[\x01-\x03]')))) >= 2),
d AS (SELECT id, pos, h, list_filter(vals, lambda v: v IS NOT NULL) AS vals FROM ({_template_windows("doc_id", "documents")}) WHERE n = 5),
hit AS (SELECT d.id AS doc_id, b.id AS item_id, b.pos AS pos, d.pos - b.pos AS diagonal, b.vals AS bv, d.vals AS dv FROM d JOIN b ON d.h = b.h),
pair AS (SELECT DISTINCT doc_id, item_id, diagonal, unnest(bv) AS x, unnest(dv) AS y FROM hit),
uneven AS (SELECT doc_id, item_id, diagonal, count(*) > count(DISTINCT x) AS broken, bool_or(x <> y) AS changed FROM pair GROUP BY ALL),
good AS (
  SELECT hit.doc_id, hit.item_id, hit.pos, coalesce(changed AND NOT broken, false) AS changed
  FROM hit LEFT JOIN uneven u ON hit.doc_id = u.doc_id AND hit.item_id = u.item_id AND hit.diagonal = u.diagonal
  WHERE NOT coalesce(broken, false) OR bv = dv)
SELECT doc_id, item_id, count(DISTINCT pos) AS n_found, any_value(n_windows) AS n_windows, bool_and(changed) AS reparameterised
FROM good JOIN (SELECT id, count(*) AS n_windows FROM b GROUP BY id) t ON t.id = item_id
GROUP BY doc_id, item_id HAVING count(DISTINCT pos) >= 0.5 * any_value(n_windows)
"""


def urls(rules: tuple[U.UrlRule, ...]) -> str:
    """The URL query: rules, one block of CTEs for each level of the tree, purity."""
    fits = lambda r: f"(host = '{r.host}' OR suffix(host, '.{r.host}')) AND prefix(path, '{r.path}')"
    longest = sorted(rules, key=lambda r: -len(r.text))
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in longest) + " END"
    ctes = [
        f"""split AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{U.UPPER}', '{U.LOWER}') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages))""",
        f"ruled AS (SELECT *, {case(lambda r: r.text)} AS rule, {case(lambda r: r.action)} AS act FROM split)",
        """p_0 AS (
  SELECT host, path, count(*) AS n, count(*) FILTER (act = 'allow') AS good, count(*) FILTER (act = 'block') AS bad,
         list_filter(string_split(path, '/'), lambda x: x <> '') AS segs, '' AS template
  FROM ruled GROUP BY host, path)""",
        "prior AS (SELECT CASE WHEN sum(good + bad) > 0 THEN sum(good) / sum(good + bad) ELSE 1.0 END AS p FROM p_0)",
    ]
    for d in range(U.MAX_DEPTH):
        seg = f"segs[{d + 1}]"
        mask = f"CASE WHEN regexp_matches({seg}, '^[0-9]+$') THEN '<n>' WHEN regexp_matches({seg}, '^[0-9a-f-]{{16,}}$') THEN '<hex>' ELSE regexp_replace({seg}, '[0-9]+', '<n>', 'g') END"
        ctes += [
            f"b_{d} AS (SELECT *, CASE WHEN len(segs) <= {d} THEN '' ELSE {mask} END AS branch FROM p_{d})",
            f"s_{d} AS (SELECT host, template, branch, sum(n) AS n, sum(good) AS good, sum(bad) AS bad FROM b_{d} GROUP BY ALL)",
            f"""f_{d} AS (
  SELECT host, template, branch, CASE WHEN branch = '' THEN '' WHEN children >= {U.MIN_CHILDREN} AND total <= {U.MAX_REPEAT} * children THEN '*'
    WHEN good + bad >= {U.MIN_LABELLED} THEN CASE WHEN z > {U.Z} THEN '{{bad}}' WHEN z < -{U.Z} THEN '{{good}}' ELSE '{{}}' END ELSE branch END AS fixed
  FROM (SELECT *, CASE WHEN share > 0 AND share < 1 AND good + bad > 0 THEN (bad / (good + bad) - share) / sqrt(share * (1 - share) / (good + bad)) ELSE 0 END AS z
        FROM (SELECT *, count(*) OVER w AS children, sum(n) OVER w AS total, CASE WHEN sum(good + bad) OVER w > 0 THEN sum(bad) OVER w / sum(good + bad) OVER w END AS share
              FROM s_{d} WINDOW w AS (PARTITION BY host, template))))""",
            f"""p_{d + 1} AS (
  SELECT host, path, n, good, bad, segs, template || CASE WHEN fixed = '' THEN '' ELSE '/' || fixed END AS template FROM b_{d} JOIN f_{d} USING (host, template, branch))""",
        ]
    last = f"p_{U.MAX_DEPTH}"
    ctes += [
        f"ends AS (SELECT host, path, good, bad, template || CASE WHEN len(segs) > {U.MAX_DEPTH} THEN '/**' ELSE '' END AS template FROM {last})",
        f"""t AS (
  SELECT host, template, CASE WHEN sum(good + bad) > 0 THEN (sum(good) + {U.PSEUDO} * (SELECT p FROM prior)) / (sum(good + bad) + {U.PSEUDO}) END AS purity
  FROM ends GROUP BY host, template)""",
    ]
    return (
        "WITH " + ",\n".join(ctes) + f"""
SELECT page_id, r.host, r.path, rule, ends.template, round(purity, 9) AS purity,
       coalesce(act, CASE WHEN purity < {U.MIN_PURITY} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r JOIN ends ON r.host = ends.host AND r.path = ends.path JOIN t ON t.host = ends.host AND t.template = ends.template"""
    )

#: The CRC of the number's digits is worked out bit by bit.
TRIE = r"""
WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), o AS (
    SELECT conv_id, md5(length(role) || ':' || role || text) AS digest,
        CAST(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS words,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos FROM t
), c AS (
    SELECT conv_id AS c, conv_id - conv_id % 20 AS base, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: CAST(ascii(d) AS BIGINT))),
        lambda crc, d: list_reduce([xor(crc, d), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))), 4294967295) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM o) i
), r AS (
    SELECT c.c, o.pos, o.digest, o.words FROM c JOIN o ON o.conv_id = c.base AND o.pos <= c.h
    UNION ALL SELECT c.c, o.pos, o.digest, o.words FROM c JOIN o ON o.conv_id = c.c AND o.pos > c.h
), p AS (
    SELECT c.c, coalesce(string_agg(digest, '' ORDER BY pos), '') AS path, coalesce(list(words ORDER BY pos) FILTER (pos IS NOT NULL), []) AS words FROM c LEFT JOIN r USING (c) GROUP BY c.c
), m AS (
    SELECT c, d AS depth, substr(path, 1, 32 * d) AS node, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(words) AS ends FROM (SELECT *, unnest(range(len(words) + 1)) AS d FROM p) q
), n AS (
    SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs, max(words) AS words, sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY node, depth
), k AS (
    SELECT a.node, (SELECT count(*) FROM n b WHERE b.depth = a.depth + 1 AND substr(b.node, 1, 32 * a.depth) = a.node) AS n_children FROM n a
), below AS (
    SELECT substr(n.node, 1, 32 * e) AS node, CASE WHEN k.n_children = 0 THEN 1 ELSE 0 END AS leaf, (n.n_convs - 1) * n.words AS saved FROM (SELECT *, unnest(range(depth + 1)) AS e FROM n) n JOIN k USING (node)
), s AS (
    SELECT node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY node
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, up.conv_id AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
    CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN k USING (node) JOIN s USING (node) LEFT JOIN n up ON up.depth = n.depth - 1 AND up.node = substr(n.node, 1, 32 * up.depth)
"""
