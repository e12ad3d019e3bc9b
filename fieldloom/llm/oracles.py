"""DuckDB SQL for the numbered queries that SQL can express."""

op10_exact_dedup = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
), g AS (
  SELECT norm, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""

_draws = "[{}]".format(
    ", ".join(
        f"CAST(('0x' || substr(md5('{k // 4}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), {1 + 8 * (k % 4)}, 8)) AS BIGINT) / 4294967296.0::DOUBLE"
        for k in range(16)
    )
)

op6_mixing = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1] AS weight
  FROM d GROUP BY source
), levels AS (
  SELECT 0 AS round, CAST(1.5 * sum(source_size) AS DOUBLE) / sum(weight) AS level, CAST(NULL AS DOUBLE) AS before FROM s
  UNION ALL
  SELECT round + 1,
         coalesce((1.5 * (SELECT sum(source_size) FROM s) - coalesce((SELECT sum(2 * source_size) FROM s WHERE 2 * source_size <= level * weight), 0))
                  / nullif(coalesce((SELECT sum(weight) FROM s WHERE 2 * source_size > level * weight), 0), 0), level),
         level
  FROM levels WHERE before IS NULL OR level > before
), t AS (
  SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE), (SELECT max(level) FROM levels) * weight) AS target FROM s
), r AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t
), e AS (
  SELECT doc_id, size, d.source, source_size, target, rate, {_draws} AS u FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
), k AS (
  SELECT e.*, i.seed, CAST(size * (floor(rate) + CASE WHEN u[i.seed + 1] < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
  FROM e, (SELECT unnest(range(16)) AS seed) i
), best AS (
  SELECT source, arg_min(seed, (off, seed)) AS seed FROM (
    SELECT source, seed, abs(sum(taken) - any_value(target)) AS off FROM k GROUP BY source, seed) GROUP BY source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken
FROM k JOIN best ON k.seed = best.seed AND k.source IS NOT DISTINCT FROM best.source
"""

op7_line_dedup = r"""
WITH RECURSIVE l AS (
  SELECT doc_id, unnest(range(len(x))) AS line_no, unnest(x) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)
), w AS (
  SELECT doc_id, line_no, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda v: v <> '') AS words FROM l
), a AS (
  SELECT doc_id, line_no, len(words) AS n, words, array_to_string(words, ' ') AS joined FROM w
), f AS (
  SELECT joined, n, words, doc_id, line_no FROM a WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY joined ORDER BY doc_id, line_no) = 1
), u AS (
  SELECT 'w' AS unit, n AS size, joined, joined AS whole, words, doc_id, line_no FROM f WHERE n >= 7
  UNION ALL SELECT 'c', length(joined), joined, joined, list_transform(range(1, length(joined) + 1), lambda k: substring(joined, CAST(k AS INT), 1)), doc_id, line_no FROM f WHERE n < 8 AND length(joined) >= 7
), v AS (
  SELECT unit, size, joined, doc_id, line_no, i, CASE unit WHEN 'w' THEN array_to_string(list_concat(words[:i - 1], words[i + 1:]), ' ') ELSE array_to_string(list_concat(words[:i - 1], words[i + 1:]), '') END AS without
  FROM (SELECT *, unnest(range(1, size + 1)) AS i FROM u WHERE size >= 8)
), ties AS (
  SELECT x.joined, y.doc_id, y.line_no FROM v x JOIN v y ON x.unit = y.unit AND x.without = y.without AND x.i = y.i AND x.size = y.size WHERE (y.doc_id, y.line_no) < (x.doc_id, x.line_no)
  UNION ALL SELECT x.joined, y.doc_id, y.line_no FROM v x JOIN u y ON x.unit = y.unit AND x.without = y.whole WHERE (y.doc_id, y.line_no) < (x.doc_id, x.line_no)
  UNION ALL SELECT y.joined, x.doc_id, x.line_no FROM v x JOIN u y ON x.unit = y.unit AND x.without = y.whole WHERE (x.doc_id, x.line_no) < (y.doc_id, y.line_no)
), first_tie AS (
  SELECT doc_id, line_no, t.p[1] AS to_doc, t.p[2] AS to_line FROM f JOIN (SELECT joined, min((doc_id, line_no)) AS p FROM ties GROUP BY joined) t USING (joined)
), walk AS (
  SELECT doc_id, line_no, to_doc, to_line FROM first_tie
  UNION ALL SELECT w.doc_id, w.line_no, t.to_doc, t.to_line FROM walk w JOIN first_tie t ON w.to_doc = t.doc_id AND w.to_line = t.line_no
), near AS (
  SELECT doc_id AS first_doc, line_no AS first_line, min((to_doc, to_line)) AS p FROM walk GROUP BY ALL
), j AS (
  SELECT a.doc_id, a.line_no, a.n, f.doc_id AS first_doc, f.line_no AS first_line, near.p[1] AS near_doc, near.p[2] AS near_line,
         CASE WHEN a.n = 0 THEN NULL WHEN (a.doc_id, a.line_no) <> (f.doc_id, f.line_no) THEN 'same' WHEN near.p IS NOT NULL THEN 'near' END AS reason
  FROM a LEFT JOIN f ON a.joined = f.joined AND a.n > 0 LEFT JOIN near ON f.doc_id = near.first_doc AND f.line_no = near.first_line
)
SELECT doc_id, CAST(line_no AS INT) AS line_no, CAST(n AS INT) AS n_words, reason IS NULL AS kept, reason,
       CASE WHEN reason IS NULL THEN doc_id ELSE coalesce(near_doc, first_doc) END AS keep_doc_id,
       CAST(CASE WHEN reason IS NULL THEN line_no ELSE coalesce(near_line, first_line) END AS INT) AS keep_line_no
FROM j
"""

_luhn = """list_sum(list_transform(range(len(digits)), lambda i: CASE WHEN i % 2 = 0 THEN CAST(digits[len(digits) - i] AS INT)
       ELSE CAST(digits[len(digits) - i] AS INT) * 2 - CASE WHEN CAST(digits[len(digits) - i] AS INT) > 4 THEN 9 ELSE 0 END END)) % 10 = 0"""
_plain = "replace(match, ' ', '')"
_mod97 = f"""list_reduce(list_prepend(0, list_transform(string_split({_plain}[5:] || {_plain}[:4], ''), lambda c: CASE WHEN ord(c) < 58 THEN ord(c) - 48 ELSE ord(c) - 55 END)),
       lambda a, v: CASE WHEN v < 10 THEN (a * 10 + v) % 97 ELSE (a * 100 + v) % 97 END) = 1"""
_countries = [
    (11, "NO"), (12, "BE"), (14, "DK FK FI FO GL NL SD"), (15, "MK SI"), (16, "AT BA EE KZ LT LU MN XK"), (17, "CH HR LI LV"),
    (18, "BG BH CR DE GB GE IE ME RS VA"), (19, "AE GI IL IQ OM SO TL"), (20, "AD CZ ES MD PK RO SA SE SK TN VG"), (21, "LY PT ST"),
    (22, "IS TR"), (23, "BI DJ FR GR IT MC MR SM"), (24, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (25, "BR EG PS QA UA"),
    (26, "JO KW MU YE"), (27, "MT SC"), (28, "LC"), (29, "RU"),
]
_kinds = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true", 0.8, "mail|contact|write|reply"),
    ("ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "list_bool_and(list_transform(string_split(match, '.'), lambda p: len(ltrim(p, '0')) <= 3 AND coalesce(TRY_CAST(ltrim(p, '0') AS INT), 0) <= 255))", 0.6, "ip|address|host|server"),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", f"len(digits) BETWEEN 14 AND 19 AND {_luhn}", 0.85, "card|visa|credit|payment"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "len(digits) BETWEEN 10 AND 15", 0.6, "phone|call|tel|mobile|fax"),
    ("iban", r"\b(?:" + "|".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n}}}" for n, c in _countries) + r")\b", _mod97, 0.9, "iban|account|bank|konto|compte|cuenta"),
    ("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "match[1:3] NOT IN ('000', '666') AND match[1:3] < '900' AND match[5:6] <> '00' AND match[8:] <> '0000'", 0.7, "ssn|social|security"),
    # An access key, or a name in any case of letters, a sign and the longest run of at least eight characters that has a digit.
    ("secret", r"\b(?:AKIA[0-9A-Z]{16}\b|(?i:pass(?:word|wd)|secret|token|api_?key) ?[:=] ?[\x22\x27]?[-A-Za-z0-9+/_]{8,})",
     r"regexp_matches(CASE WHEN starts_with(match, 'AKIA') THEN match ELSE regexp_extract(match, '[:=](.*)$', 1) END, '[0-9]')", 0.8, "aws|key|login|auth|credential"),
]
_found = " UNION ALL ".join(
    f"""SELECT doc_id, text, '{kind}' AS kind, {rank} AS rank, unnest(m) AS match, unnest(b[:len(m)]) AS gap, unnest(range(len(m))) AS i, {score} AS score, '(?:^|[^a-z0-9])(?:{words})' AS context
    FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS b FROM d)"""
    for rank, (kind, pattern, _, score, words) in enumerate(_kinds)
)
_sure = " ".join(f"WHEN '{kind}' THEN {test}" for kind, _, test, _, _ in _kinds)

op5_pii = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), f AS ({_found}), p AS (
  SELECT *, regexp_replace(match, '[^0-9]', '', 'g') AS digits,
         sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, kind ORDER BY i) - length(match) AS start FROM f
), s AS (
  SELECT doc_id, kind, rank, start, start + length(match) AS fin,
         score + CASE WHEN regexp_matches(lower(right(gap, 40)), context) THEN 0.1 ELSE 0 END AS score
  FROM p WHERE CASE kind {_sure} END
), g AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k[0]}') AS n_{k[0]}" for k in _kinds)},
         string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
         string_agg(kind || ':' || start || ':' || fin, ',' ORDER BY start, rank) AS spans,
         string_agg(printf('%.2f', CAST(score AS DOUBLE)), ',' ORDER BY start, rank) AS scores
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, {", ".join(f"coalesce(n_{k[0]}, 0) AS n_{k[0]}" for k in _kinds)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
FROM d LEFT JOIN g USING (doc_id)
"""

op11_spelling = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z{chr(0xC0)}-{chr(0xFF)}]+')) AS run FROM documents
), counted AS (
  SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS key, count(*) AS n FROM runs GROUP BY ALL
), steps AS (  -- each byte of the key, then eight shifts
  SELECT run, n, flatten(list_transform(range(0, CAST(octet_length(encode(key)) AS BIGINT)), lambda i: [CAST('0x' || hex(encode(key))[2 * i + 1:2 * i + 2] AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS steps FROM counted
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, steps), lambda c, v: CASE WHEN v >= 0 THEN xor(c, v) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) AS h FROM steps
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS INT)) || substring(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word, n FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), d AS (
  SELECT word, i, substring(word, 1, CAST(i AS INT) - 1) || substring(word, CAST(i AS INT) + 1) AS without FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)
), pairs AS (
  SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.i = y.i AND x.without = y.without AND x.word <> y.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.without = v.word
  UNION SELECT v.word, d.word FROM d JOIN v ON d.without = v.word
), best AS (
  SELECT a AS word, count(*) AS n_near, arg_min(b, (-n, b)) AS near, max(n) AS m FROM pairs JOIN v ON v.word = b GROUP BY a
), f AS (
  SELECT v.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * n THEN near END AS form, CASE WHEN m >= 2 * n THEN m END AS form_n FROM v LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at FROM f
  UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON walk.at = f.word WHERE f.form IS NOT NULL
), ends AS (
  SELECT walk.word, walk.at AS root FROM walk JOIN f ON walk.at = f.word WHERE f.form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM f JOIN ends USING (word)
"""
