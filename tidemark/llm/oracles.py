"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import string

from tidemark.llm.license_scan import PHRASES, TEMPLATES, needed

WORDS = r"[x FOR x IN string_split_regex({text}, '[\x20\x09-\x0D]+') IF x <> '']"

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM (
    SELECT conv_id, turn, role, text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')),
p AS (
  SELECT *, COALESCE(LAG(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text), '') AS last_role,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place,
         len(regexp_extract_all(text, '<s>|</s>|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[OUT\]|\[ROLE\]|\[/ROLE\]|\[/TURN\]'))
           + length(text) - length(replace(text, '\', '')) AS escapes,
         len(regexp_extract_all(role, '<s>|</s>|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[OUT\]|\[ROLE\]|\[/ROLE\]|\[/TURN\]'))
           + length(role) - length(replace(role, '\', '')) AS role_escapes
  FROM c)
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + SUM(length(text) + escapes + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
                    ELSE 20 + length(role) + role_escapes END) AS BIGINT) AS formatted_chars,
       BOOL_AND(CASE WHEN place > 1 AND last_role = '' THEN FALSE
                     WHEN last_role = '' THEN role IN ('system', 'user') WHEN last_role = 'system' THEN role = 'user'
                     WHEN last_role = 'user' THEN role = 'assistant' WHEN last_role = 'assistant' THEN role = 'user' ELSE FALSE END) AS in_order
FROM p GROUP BY conv_id
"""

MIX = f"""
WITH d AS (
  SELECT doc_id, source, len({WORDS.format(text="COALESCE(text, '')")}) AS size,
         CAST('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '') || chr(10) || COALESCE(text, '')), 1, 15) AS BIGINT) AS key
  FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, ([5.0, 2.0, 1.0])[CAST((ROW_NUMBER() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS INTEGER) + 1]::DOUBLE AS w,
             source_size * 3 AS cap FROM s),
l AS (SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / SUM(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
             ROW_NUMBER() OVER o AS place
      FROM w WINDOW o AS (ORDER BY cap / w, source IS NULL, source)),
f AS (SELECT level FROM l WHERE level * w <= cap ORDER BY place LIMIT 1),
t AS (SELECT source, source_size, LEAST(CAST(cap AS DOUBLE), COALESCE((SELECT level FROM f), 0) * w) AS target FROM w),
e AS (SELECT *, CAST(COALESCE(FLOOR(target / NULLIF(source_size, 0)), 0) AS BIGINT) AS epochs FROM t),
r AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             COALESCE(SUM(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (epochs + CASE WHEN rest > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

QUALITY = rf"""
WITH d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, lang, source, COALESCE(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, lang, source, t, {WORDS.format(text="t")} AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT r, ws, UNNEST(range(1, len(ws) - 3)) AS i FROM w)),
v AS (SELECT r, COUNT(DISTINCT p) AS n FROM (
        SELECT r, UNNEST(range(i, i + 5)) AS p FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, gram) AS n FROM g) WHERE n > 1) GROUP BY r),
c AS (SELECT w.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(COALESCE(v.n, 0) AS BIGINT) AS n_repeat_words,
             len(ls) AS n_lines
      FROM w LEFT JOIN v ON w.r = v.r),
m AS (SELECT r, lang, source, n_words, UNNEST([
             {{'k': 1, 'v': n_symbols * 1000 // GREATEST(n_words, 1)}},
             {{'k': 2, 'v': word_chars * 100 // GREATEST(n_words, 1)}},
             {{'k': 3, 'v': n_dup_lines * 1000 // GREATEST(n_lines, 1)}}]) AS x FROM c),
b AS (SELECT lang, source, x.k AS k, (x.v >> s) << s AS bucket, COUNT(*) AS n
      FROM (SELECT *, GREATEST(length(bin(CAST(x.v AS BIGINT))) - 6, 0) AS s FROM m WHERE n_words >= 10) GROUP BY ALL),
levels AS (
  SELECT 'own' AS level, lang, source, k, bucket, n FROM b
  UNION ALL SELECT 'lang', lang, NULL, k, bucket, SUM(n) FROM b GROUP BY lang, k, bucket
  UNION ALL SELECT 'all', NULL, NULL, k, bucket, SUM(n) FROM b GROUP BY k, bucket),
u AS (SELECT *, SUM(n) OVER (PARTITION BY level, lang, source, k ORDER BY bucket) AS upto,
             SUM(n) OVER (PARTITION BY level, lang, source, k) AS total FROM levels),
q AS (SELECT level, lang, source, k, MAX(total) AS n, MIN(bucket) FILTER (upto * 100 >= total * 25) AS q25,
             MIN(bucket) FILTER (upto * 100 >= total * 50) AS q50, MIN(bucket) FILTER (upto * 100 >= total * 75) AS q75
      FROM u GROUP BY level, lang, source, k),
h AS (SELECT *, q75 + room AS hi, q25 - room AS lo
      FROM (SELECT *, ([3, 6, 3])[k] * GREATEST(q75 - q25, ([50, 40, 150])[k]) AS room FROM q)),
o AS (SELECT a.lang, a.source, a.k, a.n, a.q25, a.q50, a.q75, a.hi, a.lo,
             CASE WHEN l.n < 200 THEN z.hi ELSE l.hi END AS far_hi, CASE WHEN l.n < 200 THEN z.lo ELSE l.lo END AS far_lo
      FROM h a JOIN h l ON a.level = 'own' AND l.level = 'lang' AND a.lang IS NOT DISTINCT FROM l.lang AND a.k = l.k
      JOIN h z ON z.level = 'all' AND a.k = z.k),
t AS (SELECT lang, source, k, CASE WHEN n < 200 OR q50 > far_hi OR q50 < far_lo OR q75 > far_hi THEN far_hi ELSE hi END AS hi,
             CASE WHEN n < 200 OR q50 > far_hi OR q50 < far_lo OR q25 < far_lo THEN far_lo ELSE lo END AS lo FROM o),
y AS (SELECT m.r, BOOL_OR(COALESCE(x.v > hi + room OR (x.k = 2 AND x.v < lo - room), FALSE)) AS outlier
      FROM (SELECT *, CASE WHEN x.k = 2 THEN 4000 // GREATEST(n_words, 1) ELSE 0 END AS room FROM m) m
      LEFT JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source AND m.x.k = t.k GROUP BY m.r),
j AS (SELECT c.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, outlier FROM c JOIN y ON c.r = y.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT outlier AS kept FROM j
"""


def licenses(share: float = 0.8) -> str:
    """All blocks against all templates, and all places against all phrases."""
    span = max(len(t.text.split()) for t in TEMPLATES)
    places = []
    for phrase in PHRASES:
        tests = " AND ".join(f"w[i + {k + 1}] = '{word}'" for k, word in enumerate(phrase.split()))
        places.append(f"[i FOR i IN range(0, len(w) - {len(phrase.split()) - 1}) IF {tests}]")
    base = ", ".join(f"CASE WHEN len(p{k}) > 0 THEN '{label}' END" for k, label in enumerate(PHRASES.values()))
    every = " || ".join(f"p{k}" for k in range(len(places)))
    templates = ", ".join(f"('{t.label}', {t.tokens}, {needed(t, share)})" for t in TEMPLATES)
    return rf"""
WITH t(label, tokens, need) AS (VALUES {templates}),
d AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, regexp_extract_all(
        translate(COALESCE(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT r, doc_id, w, {", ".join(f"{x} AS p{k}" for k, x in enumerate(places))} FROM d),
e AS (SELECT *, {every} AS stands, list_distinct([x FOR x IN [{base}] IF x IS NOT NULL]) AS base FROM p),
b AS (SELECT r, list_distinct(w[k * {span} + 1 : (k + 2) * {span}]) AS block
      FROM (SELECT r, w, UNNEST(range(0, GREATEST(CAST(CEIL((len(w) - {span}) / {span}) AS BIGINT), 1))) AS k FROM d)),
c AS (SELECT r, label, need, len(tokens) AS n, len(list_intersect(tokens, block)) AS common FROM b, t),
f AS (SELECT r, list(DISTINCT label) AS more, MAX(common / n) AS best FROM c WHERE common >= need GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(stands) AS BIGINT) AS n_base, list_min(stands) AS first_word, list_max(stands) AS last_word,
       array_to_string(list_sort(base), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(base || COALESCE(more, []))), ',') AS labels,
       CASE WHEN len(stands) > 0 THEN 1.0::DOUBLE ELSE COALESCE(best, 0.0::DOUBLE) END AS score
FROM e LEFT JOIN f ON e.r = f.r
"""


LICENSES = licenses()


def merkle(levels: int = 7, root_levels: int = 3) -> str:
    """Trees level by level, for groups of up to ``8 ** levels`` rows and as many as ``8 ** root_levels`` groups."""
    fields = lambda text: " || ".join(
        f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END" for x in ("doc_id", "source", "lang", "n_chars", text)
    )
    bits = "[4294967295] || flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])"
    step = "CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    sql = f"""
WITH a AS (SELECT *, {fields("text")} AS own,
             {fields(f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')")} AS other,
             xor(list_reduce(CAST({bits} AS BIGINT[]), lambda c, e: {step}), 4294967295) AS crc FROM documents),
b AS (SELECT ROW_NUMBER() OVER () AS r, doc_id, lang, sha256(own) AS leaf,
             sha256(CASE WHEN crc % 3 = 0 THEN other ELSE own END) AS changed FROM a),
g AS (SELECT lang, ROW_NUMBER() OVER (ORDER BY lang NULLS FIRST) - 1 AS g FROM (SELECT DISTINCT lang FROM b)),
d0 AS (SELECT r, doc_id, leaf, g, ROW_NUMBER() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
              changed AS f, '' AS proof FROM b JOIN g ON b.lang IS NOT DISTINCT FROM g.lang),
t0 AS (SELECT g, p, leaf AS h, COUNT(*) OVER (PARTITION BY g) AS n FROM d0)"""
    around = "COALESCE(string_agg(h, '') OVER (PARTITION BY g, p // 8 ORDER BY p ROWS BETWEEN {}), '')"
    for k in range(levels + root_levels):
        nodes, docs = f"t{k}", f"d{k}"
        if k == levels:  # the subroots are the nodes of one more tree
            sql += f""",
tr AS (SELECT 0 AS g, g AS p, h, COUNT(*) OVER () AS n FROM t{k}),
dr AS (SELECT r, doc_id, leaf, 0 AS g, g AS p, f, proof FROM d{k})"""
            nodes, docs = "tr", "dr"
        sql += f""",
r{k} AS (SELECT *, {around.format("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS lefts, {around.format("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS rights FROM {nodes}),
d{k + 1} AS (SELECT r, doc_id, leaf, d.g, d.p // 8 AS p, CASE WHEN n = 1 THEN f ELSE sha256(lefts || f || rights) END AS f,
                    proof || lefts || rights AS proof FROM {docs} d JOIN r{k} x ON d.g = x.g AND d.p = x.p),
t{k + 1} AS (SELECT g, p // 8 AS p, CASE WHEN n = 1 THEN MIN(h) ELSE sha256(string_agg(h, '' ORDER BY p)) END AS h, (n + 7) // 8 AS n
             FROM {nodes} GROUP BY g, p // 8, n)"""
    last = levels + root_levels
    return sql + f"""
SELECT d.doc_id, d.leaf, s.h AS subroot, (SELECT h FROM t{last}) AS root, sha256(d.proof) AS proof_sha256, d.f AS folded_root,
       d.f = (SELECT h FROM t{last}) AS verified
FROM d{last} d JOIN d0 ON d.r = d0.r JOIN t{levels} s ON s.g = d0.g
"""


MERKLE = merkle()

SEARCH = rf"""
WITH t AS (SELECT r, doc_id, UNNEST(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT ROW_NUMBER() OVER () AS r, doc_id, text FROM documents)),
q AS (SELECT DISTINCT item_id, UNNEST(regexp_extract_all(translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
p AS (SELECT r, doc_id, term, COUNT(*) AS tf FROM t GROUP BY r, doc_id, term),
n AS (SELECT r, COUNT(*) AS n FROM t GROUP BY r),
s AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS terms FROM n),
m AS (SELECT r, 100 - 50 + ((50 * n * docs) // terms) AS m FROM n, s),
w AS (SELECT term, CAST(FLOOR(1000 * ln((2 * docs + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
x AS (SELECT item_id, r, doc_id, CAST(SUM(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 50
"""
