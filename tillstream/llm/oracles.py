"""DuckDB SQL for the corpus queries that SQL can express.

The others (token ids, packing, trained models, connected components, edit
matching) are held against brute-force versions in ``tests/llm``.
"""

from __future__ import annotations

from .license_scan import TEMPLATES, THRESHOLD
from .url_reputation import (
    ADDRESS_SUFFIX,
    LOWER,
    MAX_STRENGTH,
    MIN_STRENGTH,
    PRIOR_RATE,
    RULES,
    SECOND_LEVEL,
    UPPER,
    Z,
)
from .url_reputation import THRESHOLD as RATE

ORACLE: dict[str, str] = {}

ORACLE["op6_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT text_sha256, arg_min(doc_id, (-length(t), doc_id)) AS keep_id, count(*) AS group_size
  FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""


def _text(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _words(c: str) -> str:
    plain = f"trim(regexp_replace(regexp_replace(lower({c}), '[''’]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"
    return f"string_split({plain}, ' ')"


ORDERED = "list_transform(list_zip(w[1:len(w) - 1], w[2:]), lambda p: p[1] || ' ' || p[2])"
PAIRS = f"list_distinct({ORDERED})"


ORACLE["op4_license_scan"] = rf"""
WITH template AS (
  SELECT license, {PAIRS} AS b, len(w) AS n, row_number() OVER () AS t
  FROM (SELECT license, {_words('body')} AS w FROM (VALUES {', '.join(f'({_text(x)}, {_text(y)})' for x, y in TEMPLATES)})
        AS v(license, body))),
parts AS (
  SELECT doc_id, 'document' AS kind, [text] AS pieces FROM documents WHERE text IS NOT NULL
  UNION ALL
  SELECT doc_id, 'paragraph', regexp_split_to_array(text, '\n[\x20\x09\x0D]*\n\s*') FROM documents
  WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, 'line', string_split(text, chr(10)) FROM documents WHERE text IS NOT NULL),
segments AS (
  SELECT DISTINCT doc_id, kind, unnest(pieces) AS segment FROM parts
  WHERE kind = 'document' OR len(pieces) > 1),
own AS (SELECT doc_id, kind, segment, {PAIRS} AS a
        FROM (SELECT *, {_words('segment')} AS w FROM segments) WHERE len(w) > 1),
scored AS (
  SELECT doc_id, kind, segment, license, 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
  FROM own JOIN template ON len(a) BETWEEN 1 AND 3 * len(b) AND len(b) <= 3 * len(a)),
-- Runs of a template's length that begin with one of its bigrams.
whole AS (
  SELECT r, doc_id, {ORDERED} AS a
  FROM (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w
        FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)) WHERE len(w) > 1),
start AS (SELECT DISTINCT t, unnest(b) AS g FROM template),
place AS (SELECT r, unnest(a) AS g, unnest(range(len(a))) AS pos FROM whole),
-- A run without enough such places before its end is ruled out.
near AS (
  SELECT r, t, pos, n, b, license,
         lead(pos, CAST(ceil(len(b) * {THRESHOLD} / (2 - {THRESHOLD}) - 1e-9) AS INTEGER) - 1)
           OVER (PARTITION BY r, t ORDER BY pos) AS later
  FROM place JOIN start USING (g) JOIN template USING (t)),
run AS (
  SELECT r, doc_id, t, license, n, pos, least(pos + n, len(a) + 1) AS stop, b, a[pos + 1:pos + n - 1] AS x
  FROM near JOIN whole USING (r) WHERE later - pos <= n - 2),
rated AS (
  SELECT * FROM (
    SELECT *, 2.0 * len(list_intersect(list_distinct(x), b)) / (len(list_distinct(x)) + len(b)) AS dice FROM run)
  WHERE dice >= {THRESHOLD} - 1e-12),
peak AS (
  SELECT * FROM rated
  WINDOW o AS (PARTITION BY r, t ORDER BY pos)
  QUALIFY (lag(pos) OVER o IS NULL OR pos - lag(pos) OVER o >= n OR lag(dice) OVER o < dice)
      AND (lead(pos) OVER o IS NULL OR lead(pos) OVER o - pos >= n OR lead(dice) OVER o <= dice)),
excerpt AS (
  SELECT doc_id, 'excerpt' AS kind, array_to_string(x, '|') AS segment, license, dice FROM peak p
  WHERE NOT EXISTS (
    FROM peak q WHERE q.r = p.r AND 2 * (least(p.stop, q.stop) - greatest(p.pos, q.pos)) > p.stop - p.pos
      AND (q.dice, q.stop - q.pos, q.license, -q.pos) > (p.dice, p.stop - p.pos, p.license, -p.pos))),
top AS (
  SELECT doc_id, kind, segment, max((dice, license)) AS best
  FROM (FROM scored UNION ALL FROM excerpt)
  WHERE dice >= {THRESHOLD} - 1e-12 GROUP BY ALL),
named AS (SELECT doc_id, kind, best[1] AS dice, best[2] AS license FROM top),
final AS (
  SELECT doc_id, license, max((dice, kind)) AS best, count(*) AS segments FROM named GROUP BY ALL)
SELECT doc_id, license, best[1] AS dice, best[2] AS kind, segments FROM final
"""


def _strength(m: str) -> str:
    return (f"least(greatest(coalesce(sum(n * {m} * (1 - {m})) / nullif(sum(n * (good / n - {m}) "
            f"* (good / n - {m})), 0) - 1, {MAX_STRENGTH}), {MIN_STRENGTH}), {MAX_STRENGTH})")


def _level(name: str, rows: str, m: str) -> str:
    """A level's strength as a one-row relation, over its labelled members."""
    return f"{name} AS (SELECT {_strength(m)} AS s FROM (SELECT * FROM {rows} WHERE n > 0))"


ORACLE["op10_url_reputation"] = rf"""
WITH p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
judged AS (
  SELECT host, CAST(quality = 1 AS INTEGER) AS ok FROM p JOIN labels ON page_id = doc_id
  WHERE quality IS NOT NULL),
counts AS (SELECT host, count(*) AS n, sum(ok) AS good FROM judged GROUP BY host),
named AS (
  SELECT host, rtrim(regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$', ''), '.') AS name
  FROM (SELECT DISTINCT host FROM p)),
split AS (
  SELECT host, name, string_split(name, '.') AS l,
         regexp_full_match(name, '\[.*\]|[0-9]{{1,3}}(\.[0-9]{{1,3}}){{3}}', 's') AS numeric,
         CASE WHEN list_contains([{', '.join(_text(x) for x in SECOND_LEVEL)}], l[-2])
                   AND regexp_full_match(l[-1], '[a-z]{{2}}') THEN 2 ELSE 1 END AS k
  FROM named),
h AS (
  SELECT host, coalesce(n, 0.0) AS n, coalesce(good, 0.0) AS good,
         CASE WHEN numeric THEN name ELSE array_to_string(l[greatest(len(l) - k, 1):], '.') END AS domain,
         CASE WHEN numeric THEN '{ADDRESS_SUFFIX}'
              ELSE array_to_string(l[greatest(len(l) - k + 1, 1):], '.') END AS suffix
  FROM split LEFT JOIN counts USING (host)),
total AS (SELECT CASE WHEN sum(n) > 0 THEN (sum(good) + 1.0) / (sum(n) + 2.0) ELSE {PRIOR_RATE} END AS m0 FROM h),
x1 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, m0 FROM h, total GROUP BY suffix, m0),
{_level('s1', 'x1', 'm0')},
y1 AS (SELECT suffix, (s * m0 + good) / (s + n) AS m1 FROM x1, s1),
x2 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h GROUP BY ALL),
z2 AS (SELECT x2.*, m1 FROM x2 JOIN y1 USING (suffix)),
{_level('s2', 'z2', 'm1')},
y2 AS (SELECT domain, (s * m1 + good) / (s + n) AS m2 FROM z2, s2),
z3 AS (SELECT h.*, m2 FROM h JOIN y2 USING (domain)),
{_level('s3', 'z3', 'm2')},
y3 AS (SELECT host, s * m2 + good AS a, s * (1 - m2) + n - good AS b FROM z3, s3),
v AS (
  SELECT host, CASE WHEN a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) >= {RATE}
                    THEN 'allow' ELSE 'block' END AS reputation FROM y3),
rules AS (SELECT * FROM (VALUES {', '.join(f'({_text(a)}, {_text(b)}, {_text(c)})' for a, b, c in RULES)})
          AS r(rhost, rpath, rverdict)),
fit AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(rverdict, length(rhost || rpath)) AS rverdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id)
SELECT p.page_id, host, path, rule, coalesce(rverdict, reputation) AS verdict
FROM p LEFT JOIN fit USING (page_id) JOIN v USING (host)
"""

# Lines as the contract's pattern cuts them; the restored text is taken from the
# output again, between the markers.
ORACLE["op13_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
k AS (
  SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS k1,
         CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS k2,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
           OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 AS plain,
         CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 AS spm
  FROM d),
c AS (
  SELECT doc_id, text, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
         array_to_string(lines[1:least(k1, k2)], '') AS p,
         array_to_string(lines[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
         array_to_string(lines[greatest(k1, k2) + 1:], '') AS s
  FROM k),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
  FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256,
       sha256(CASE form
         WHEN 'plain' THEN output
         WHEN 'psm' THEN split_part(split_part(output, '<P>', 2), '<S>', 1) || split_part(output, '<M>', 2)
                         || split_part(split_part(output, '<S>', 2), '<M>', 1)
         ELSE split_part(split_part(output, '<P>', 2), '<M>', 1) || split_part(output, '<M>', 2)
              || split_part(split_part(output, '<S>', 2), '<P>', 1) END) AS restored_sha256
FROM o
"""
