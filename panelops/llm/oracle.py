"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from panelops.llm.url_reputation import SUFFIXES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CONVERSATIONS = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
),
f AS (
  SELECT *,
    length('<|im_start|>') + length(regexp_replace(
      replace(replace(role, '%', '%25'), chr(10), '%0A'),
      '([<\[])(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g')) + 1
    + length(regexp_replace(text,
      '([<\[])(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\\\2\3', 'g'))
    + length('<|im_end|>') + 1 AS chars
  FROM t
),
g AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, role, text)
             FILTER (WHERE role = 'assistant'), '') AS learned
  FROM f GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learned) AS loss_chars,
       sha256(learned) AS loss_sha256, formatted_chars
FROM g
"""

JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 75 * (x.n + y.n - k)
),
r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT l.a, r.c FROM r JOIN l ON l.b = r.doc_id
),
m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN m ON m.doc_id = d.doc_id
"""


def _concentration(level: str) -> str:
    """Method of moments over the units of ``level``, as one scalar."""
    return f"""(
    SELECT CASE WHEN d IS NULL OR d = 0 OR rest IS NULL OR rest <= 0 OR d <= e THEN 1000.0
           ELSE least(greatest(rest / (d - e) - 1, 2.0), 1000.0) END
    FROM (SELECT sum(n * pow(good / n - prior, 2)) AS d, sum(prior * (1 - prior)) AS e,
                 sum((n - 1) * prior * (1 - prior)) AS rest FROM {level} WHERE n > 0))"""


def _shrunk(level: str, keys: str) -> str:
    return f"""
  SELECT {keys}, n, good, (good + wt * prior) / (n + wt) AS prior, n + wt AS strength
  FROM (SELECT *, least({_concentration(level)}, strength) AS wt FROM {level})"""


URLS = rf"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
    ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages
),
v AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS raw FROM u),
q AS (
  SELECT page_id, translate(raw, '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) AS path FROM v
),
marks AS (
  SELECT doc_id, min(quality) AS good FROM labels
  WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
),
o AS (
  SELECT host, count(*) AS n, sum(good) AS good FROM q JOIN marks ON marks.doc_id =
    try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\.html)?/?$', 1), '') AS BIGINT)
  GROUP BY host
),
names AS (
  SELECT DISTINCT host, str_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM q
),
depth AS (
  SELECT host, parts, CASE
      WHEN regexp_full_match(array_to_string(parts, '.'), '[0-9]+(\.[0-9]+){{3}}')
        OR starts_with(host, '[') THEN 0
      WHEN array_to_string(parts[-2:], '.') IN ({", ".join(f"'{s}'" for s in SUFFIXES)}) THEN 2
      ELSE 1 END AS k FROM names
),
h AS (
  SELECT host, array_to_string(CASE WHEN k = 0 THEN parts ELSE parts[-(k + 1):] END, '.') AS domain,
    array_to_string(CASE WHEN k = 0 THEN parts ELSE parts[-k:] END, '.') AS suffix,
    coalesce(n, 0)::DOUBLE AS n, coalesce(good, 0)::DOUBLE AS good
  FROM depth LEFT JOIN o USING (host)
),
c AS (SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS prior,
             coalesce(sum(n), 0) + 2 AS strength FROM h),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good, any_value(c.prior) AS prior,
              any_value(c.strength) AS strength FROM h, c GROUP BY suffix),
s1 AS ({_shrunk("s0", "suffix")}),
d0 AS (
  SELECT g.*, s1.prior, s1.strength FROM (
    SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM h GROUP BY suffix, domain) g
  JOIN s1 USING (suffix)
),
d1 AS ({_shrunk("d0", "suffix, domain")}),
h0 AS (SELECT h.host, h.n, h.good, d1.prior, d1.strength, d1.n AS domain_n
       FROM h JOIN d1 USING (suffix, domain)),
h1 AS ({_shrunk("h0", "host, domain_n")}),
b AS (
  SELECT host, domain_n, prior AS mean, round(prior + 1.645 * sqrt(prior * (1 - prior) / (strength + 1)), 6)
    AS upper FROM h1
),
r AS (
  SELECT q.*, b.mean, b.upper, b.domain_n, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
      THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
      THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END
    AS rule
  FROM q JOIN b USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN rule IS NOT NULL THEN 'block'
       WHEN upper < 0.5 AND domain_n > 0 THEN 'block' ELSE 'allow' END AS verdict,
  round(mean, 6) AS reputation, upper
FROM r
"""

def _cheapest(*options: str) -> str:
    return f"least({', '.join(options)})"


def _edit(letter: str, cost: str, behind: str) -> str:
    """A way, as cost (eight digits) and letters, with one edit before it."""
    return f"(lpad((left({behind}, 8)::INT + {cost})::VARCHAR, 8, '0') || '{letter}' || substr({behind}, 9))"


def _repairs() -> str:
    """Cheapest way from each state (n nothing, s, u, a) to the end, row by
    row from the last; the letters are kept, so that ties go to the least."""
    kept = {"n": ("'s'", "s", "'u'", "u"), "s": ("'u'", "u"), "u": ("'a'", "a"), "a": ("'u'", "u")}
    other = {"n": "u", "s": "u", "u": "a", "a": "u"}
    before = []
    for s in "nsua":
        ways = [_edit("D", "4", f"r.{s}")]
        whens = kept[s]
        keep = " ".join(
            f"WHEN x.initial = {whens[k]} THEN {_edit('K', 'x.extra', 'r.' + whens[k + 1])}"
            for k in range(0, len(whens), 2)
        )
        ways.append(f"CASE WHEN x.must THEN NULL {keep} END")
        ways.append(f"CASE WHEN NOT x.must THEN {_edit('R', '3 + x.extra', 'r.' + other[s])} END")
        before.append(f"{_cheapest(*ways)} AS {s}0")
    u1 = _cheapest("u0", _edit("I", "3", "a0"))
    a1 = _cheapest("a0", _edit("I", "3", "u0"))
    return f"""
  SELECT conv_id, k, {_cheapest('n0', _edit('I', '3', 'u1'))} AS n,
    {_cheapest('s0', _edit('I', '3', 'u1'))} AS s, u1 AS u, a1 AS a
  FROM (SELECT *, {u1} AS u1, {a1} AS a1 FROM (
    SELECT r.conv_id, r.k - 1 AS k, {', '.join(before)}
    FROM r JOIN x ON x.conv_id IS NOT DISTINCT FROM r.conv_id AND x.spot = r.k))"""


REPAIR = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
),
crc AS (
  -- One list element per bit, the byte with the first of its eight.
  SELECT *, xor(list_reduce(flatten(list_transform(str_split(name, ''),
      lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1)), 4294967295::BIGINT),
    4294967295) % 20 AS kind
  FROM named
),
hurt AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM crc WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS spot
  FROM hurt
),
judged AS (
  SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS final,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1 AS again,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY spot), 1) || left(role, 1) AS pair,
    lag(role) OVER (PARTITION BY conv_id ORDER BY spot) IS NOT NULL AS follows
  FROM placed
),
x AS (
  SELECT *, final = '' AS blank, final <> '' AND again AS duplicate,
    final = '' OR again AS must, CASE WHEN final IN ('.', '!', '?') THEN 0 ELSE 3 END AS extra
  FROM judged
),
r AS (
  SELECT conv_id, max(spot) AS k, '00000000' AS n, '00000006II' AS s, '00000003I' AS u, '00000000' AS a
  FROM x GROUP BY conv_id
  UNION ALL {_repairs()}
),
best AS (SELECT conv_id, left(n, 8)::BIGINT AS cost, substr(n, 9) AS audit FROM r WHERE k = 0),
letters AS (
  SELECT conv_id, unnest(str_split(audit, '')) AS edit,
    unnest(range(1, length(audit) + 1)) AS place FROM best WHERE audit <> ''
),
numbered AS (
  SELECT *, sum((edit <> 'I')::INT) OVER w AS spot, sum((edit <> 'D')::INT) OVER w AS made
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY place)
),
-- Rows that are not kept alternate, by what is before them; the state after
-- a kept row is its initial.
made AS (
  SELECT e.conv_id, e.made, e.edit, x.role, CASE WHEN edit = 'I' THEN '' ELSE x.text END AS text,
    CASE WHEN edit = 'K' THEN x.initial END AS known
  FROM numbered e LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM e.conv_id AND x.spot = e.spot
  WHERE edit <> 'D'
),
spans AS (
  SELECT *, count(known) OVER (PARTITION BY conv_id ORDER BY made) AS span FROM made
),
spoken AS (
  SELECT conv_id, made, text, CASE WHEN edit = 'K' THEN role
    WHEN first_value(known) OVER s = 'u' THEN
      CASE WHEN row_number() OVER s % 2 = 0 THEN 'assistant' ELSE 'user' END
    WHEN first_value(known) OVER s IS NULL THEN
      CASE WHEN row_number() OVER s % 2 = 1 THEN 'user' ELSE 'assistant' END
    ELSE CASE WHEN row_number() OVER s % 2 = 0 THEN 'user' ELSE 'assistant' END END AS role
  FROM spans WINDOW s AS (PARTITION BY conv_id, span ORDER BY made)
),
hashed AS (
  SELECT conv_id, sha256(string_agg(role || ':' || text, chr(10) ORDER BY made)) AS sha
  FROM spoken GROUP BY conv_id
),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
    count(*) FILTER (WHERE NOT must AND extra > 0) AS truncated,
    count(*) FILTER (WHERE follows AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM x GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank,
  coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLE = {
    "op4_reply_trees": CONVERSATIONS,
    "op9_jaccard_join": JACCARD,
    "op10_url_reputation": URLS,
    "op12_chat_repair": REPAIR,
}
