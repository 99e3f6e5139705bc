"""The same results in SQL, where SQL can express them."""

from placeleads.llm.fingerprints import BASE, PRIME, SECOND_BASE, UNITS
from placeleads.llm.quality_rules import BOILERPLATE

_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"
_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP5 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents WHERE text IS NOT NULL
), numbered AS (
  SELECT doc_id, n, trim(raw, {_TRIM}) AS line,
         row_number() OVER (PARTITION BY doc_id ORDER BY n) AS k
  FROM lines WHERE trim(raw, {_TRIM}) <> ''
), around AS (
  SELECT doc_id, k, line, lead(line, 1) OVER d AS second, lead(line, 2) OVER d AS third,
         words, lead(words, 1) OVER d AS more, count(*) OVER (PARTITION BY doc_id) AS total
  FROM (SELECT *, len(regexp_extract_all(line, '{_WORD}')) AS words FROM numbered)
  WINDOW d AS (PARTITION BY doc_id ORDER BY k)
), windows AS (
  SELECT doc_id, k, 3 AS size, line || chr(10) || second || chr(10) || third AS x FROM around
  WHERE third IS NOT NULL AND length(line) + length(second) + length(third) >= 60
  UNION ALL
  SELECT doc_id, k, 2, line || chr(10) || second FROM around
  WHERE words + more >= 20 OR (total = 2 AND length(line) + length(second) >= 60)
  UNION ALL
  SELECT doc_id, k, 1, line FROM around WHERE words >= 20 OR (total = 1 AND length(line) >= 60)
), ranked AS (
  SELECT doc_id, k, size, row_number() OVER (PARTITION BY size, x ORDER BY doc_id, k) AS place
  FROM windows
), gone AS (
  SELECT DISTINCT n.doc_id, n.n, n.k FROM ranked r JOIN numbered n
  ON n.doc_id = r.doc_id AND n.k BETWEEN r.k AND r.k + r.size - 1 WHERE r.place > 1
), runs AS (
  SELECT doc_id, count(*) AS removed, count(*) FILTER (before IS NULL OR before < k - 1) AS runs
  FROM (SELECT *, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM gone) GROUP BY doc_id
), left_over AS (
  SELECT l.doc_id, string_agg(l.raw, chr(10) ORDER BY l.n) AS text,
         count(*) FILTER (trim(l.raw, {_TRIM}) <> '') AS full_lines
  FROM lines l ANTI JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(r.removed, 0) AS n_removed, coalesce(r.runs, 0) AS n_runs,
       CASE WHEN r.removed IS NULL THEN d.text
            WHEN coalesce(o.full_lines, 0) = 0 THEN '' ELSE o.text END AS text
FROM documents d LEFT JOIN runs r USING (doc_id) LEFT JOIN left_over o USING (doc_id)
"""

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6 = f"""
WITH docs AS (
  SELECT doc_id, {_TERMS.format(_LOW.format("coalesce(text, '')"))} AS w FROM documents
), items AS (
  SELECT item_id, {_TERMS.format(_LOW.format("coalesce(text, '')"))} AS w FROM benchmark
), wanted AS (
  SELECT DISTINCT item_id, w[i:i + 9] AS x, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM wanted), places AS (
  SELECT doc_id, i, n, w[i:i + n - 1] AS x
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
), found AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN wanted USING (x)
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP7 = f"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents
), sets AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM sets x JOIN sets y
    ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
  ) p JOIN sizes m ON m.doc_id = p.a JOIN sizes n ON n.doc_id = p.b
  WHERE 100 * p.o >= 90 * (m.n + n.n - p.o)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
"""


def _spans(kind: str, pattern: str, good: str) -> str:
    """Matches of a pattern with their places, of which the good ones stay."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, m, before,
         CAST(len_before AS BIGINT) AS start_, CAST(len_before + length(m) AS BIGINT) AS stop_
  FROM (
    SELECT doc_id, ms[i] AS m, ps[i] AS before,
           list_sum([length(p) FOR p IN ps[1:i]]) + coalesce(list_sum([length(q) FOR q IN ms[1:i - 1]]), 0) AS len_before
    FROM (
      SELECT doc_id, ms, ps, unnest(range(1, len(ms) + 1)) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
    )
  ) WHERE {good}"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (
    "list_sum([CASE WHEN k % 2 = 0 THEN CAST(reverse(d)[k + 1] AS INT) "
    "ELSE (2 * CAST(reverse(d)[k + 1] AS INT)) // 10 + (2 * CAST(reverse(d)[k + 1] AS INT)) % 10 END "
    "FOR k IN range(0, length(d))]) % 10 = 0"
).replace("d)", f"{_DIGITS})")
_IBAN = "replace(m, ' ', '')"
_MOD97 = (
    "CAST(array_to_string([CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END "
    f"FOR c IN string_split({_IBAN}[5:] || {_IBAN}[:4], '')], '') AS HUGEINT) % 97 = 1"
)

OP8 = f"""
WITH found AS (
{_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true")}
UNION ALL {_spans("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", "list_max([CAST(x AS DOUBLE) FOR x IN string_split(m, '.')]) <= 255")}
UNION ALL {_spans("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}")}
UNION ALL {_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15")}
UNION ALL {_spans("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b", f"length({_IBAN}) BETWEEN 15 AND 34 AND {_MOD97}")}
UNION ALL {_spans("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "NOT regexp_matches(m, '^(?:000|666|9)') AND NOT regexp_matches(m, '-00-|-0000$') AND regexp_matches(lower(right(before, 40)), 'ssn|social|security|tax')")}
), ranked AS (
  SELECT doc_id, kind, list_position(['email', 'ip', 'card', 'phone', 'iban', 'ssn'], kind) AS r, start_,
         kind || ':' || start_ || ':' || stop_ AS s FROM found
), summed AS (
  SELECT doc_id, count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
         count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone,
         string_agg(s, ',' ORDER BY r, start_) FILTER (r <= 4) AS base,
         string_agg(s, ',' ORDER BY r, start_) AS spans
  FROM ranked GROUP BY doc_id
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN summed USING (doc_id)
"""

OP9 = """
WITH docs AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), windows AS (
  SELECT doc_id, i, h[2 * i + 1:2 * i + 100] AS w
  FROM (SELECT doc_id, h, unnest(range(0, n - 49)) AS i FROM docs WHERE n >= 50)
), firsts AS (
  SELECT w, min(doc_id) AS first FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), starts AS (
  SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before
  FROM windows JOIN firsts USING (w) WHERE doc_id > first
), pieces AS (
  SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 50 THEN 1 ELSE 0 END)
         OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts
), runs AS (
  SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b,
         lag(max(i) + 50, 1, 0) OVER (PARTITION BY doc_id ORDER BY run) AS end_before
  FROM pieces GROUP BY doc_id, run
), cut AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS last,
         string_agg(h[2 * end_before + 1:2 * a], '' ORDER BY run) AS kept
  FROM runs JOIN docs USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       coalesce(spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN removed IS NULL THEN h ELSE kept || h[2 * last + 1:] END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)
"""

_PHRASES = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)

OP10 = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
), repeated AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 8)) AS j FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x) AS c FROM (
        SELECT doc_id, i, w[i:i + 7] AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)
      )
    ) WHERE c > 1
  ) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs
), by_line AS (
  SELECT doc_id,
         count(*) FILTER (regexp_matches(line, '{_WORD}'))
           - count(DISTINCT line) FILTER (regexp_matches(line, '{_WORD}')) AS n_dup_lines,
         sum(CASE WHEN len(regexp_extract_all(line, '[#*$%&<>!]')) * 100 > 20 * chars
                    OR len(regexp_extract_all(line, '[#*$%&<>!]([\\x20\\x09-\\x0D]|$)')) * 100
                       > 50 * len(regexp_extract_all(line, '{_WORD}'))
                    OR (len(regexp_extract_all(line, '[|>»›·•]')) >= 3
                        AND len(list_filter(string_split_regex(line, '[|>»›·•]'),
                              lambda i: len(regexp_extract_all(i, '{_WORD}')) <= 4)) * 100
                            >= 80 * (len(regexp_extract_all(line, '[|>»›·•]')) + 1))
                    OR {_PHRASES}
                  THEN 0 ELSE chars END) AS left_over
  FROM (SELECT *, length(regexp_replace(line, '{_SPACE}', '', 'g')) AS chars FROM lines) GROUP BY doc_id
), counted AS (
  SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, left_over
  FROM docs d JOIN by_line USING (doc_id) LEFT JOIN repeated r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND NOT (word_chars - left_over) * 100 > 50 * word_chars AS kept
FROM counted
"""

# The checksum is CRC-32, worked out per distinct unit with the usual table of bytes.
OP11 = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id)) AS following
  FROM documents
), texts AS (
  SELECT doc_id, 0 AS kind, t FROM docs UNION ALL
  SELECT doc_id, 1, substring(t, 1, length(t) - length(t) // 2) || substring(following, 1, length(t) // 2)
  FROM docs
), bytes AS (
  SELECT list(c ORDER BY i) AS codes FROM (
    SELECT i, list_reduce(range(8), lambda c, n: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                                                       ELSE c >> 1 END, i) AS c
    FROM range(256) r(i))
), split AS (
  SELECT doc_id, kind, regexp_extract_all(t, '{UNITS}') AS units FROM texts
), unit AS (
  SELECT doc_id, kind, len(units) AS n, unnest(units) AS u, generate_subscripts(units, 1) - 1 AS i
  FROM split
), sums AS (
  SELECT u, xor(list_reduce(
              list_transform(range(strlen(u)), lambda b: ('0x' || substring(hex(u), 2 * b + 1, 2))::BIGINT),
              lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)
            % {PRIME - 1} + 1 AS code
  FROM (SELECT DISTINCT u FROM unit), bytes
), rolled AS (
  SELECT doc_id, kind, n, i,
         coalesce(lead(code, 1) OVER d, 0) AS c1, coalesce(lead(code, 2) OVER d, 0) AS c2, code AS c0
  FROM unit JOIN sums USING (u) WINDOW d AS (PARTITION BY doc_id, kind ORDER BY i)
), grams AS (
  SELECT doc_id, kind, greatest(n - 2, 1) AS grams, i,
         ((((c0 * {BASE} + c1) % {PRIME}) * {BASE} + c2) % {PRIME}) * {PRIME + 1} + {PRIME} - i AS k,
         (((c0 * {SECOND_BASE} + c1) % {PRIME}) * {SECOND_BASE} + c2) % {PRIME} AS more
  FROM rolled WHERE i = 0 OR i + 2 < n
), windows AS (
  SELECT doc_id, kind, i, grams, min(k) OVER (
    PARTITION BY doc_id, kind ORDER BY i ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS k
  FROM grams
), chosen AS (
  SELECT DISTINCT doc_id, kind, {PRIME} - k % {PRIME + 1} AS i FROM windows
  WHERE i = 0 OR i + 3 < grams
), marks AS (
  SELECT doc_id, kind, i, g.k - g.k % {PRIME + 1} + g.more AS h
  FROM chosen JOIN grams g USING (doc_id, kind, i)
), prints AS (
  SELECT b.doc_id, b.kind, any_value(t) AS t, coalesce(list(DISTINCT h) FILTER (h IS NOT NULL), []) AS hs,
         coalesce(string_agg(hex(h) || ':' || i, ',' ORDER BY i) FILTER (h IS NOT NULL), '') AS print
  FROM texts b LEFT JOIN marks m ON m.doc_id = b.doc_id AND m.kind = b.kind GROUP BY b.doc_id, b.kind
), compared AS (
  SELECT o.doc_id, o.t, e.t AS edited, o.print, e.print AS edited_print, o.hs AS a, e.hs AS b,
         coalesce(lead(o.hs) OVER (ORDER BY o.doc_id), first_value(o.hs) OVER (ORDER BY o.doc_id)) AS c
  FROM prints o JOIN prints e ON e.doc_id = o.doc_id AND e.kind = 1 WHERE o.kind = 0
)
SELECT doc_id, length(t) AS n_chars, sha256(edited) AS edited_sha256, print AS fingerprint,
       edited_print AS edited_fingerprint,
       CASE WHEN len(a) + len(b) = 0 THEN 1.0::DOUBLE
            ELSE 2 * len(list_intersect(a, b))::DOUBLE / (len(a) + len(b)) END AS near_edited,
       CASE WHEN len(a) + len(c) = 0 THEN 1.0::DOUBLE
            ELSE 2 * len(list_intersect(a, c))::DOUBLE / (len(a) + len(c)) END AS near_next
FROM compared
"""

OP12 = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256('1:' || doc_id) AS x FROM documents
), cut AS (
  SELECT doc_id, t, n, ('0x' || substring(x, 1, 8))::BIGINT % (n + 1) AS a,
         ('0x' || substring(x, 9, 8))::BIGINT % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || substring(x, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
              WHEN ('0x' || substring(x, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, substring(t, 1, least(a, b)) AS p, substring(t, greatest(a, b) + 1) AS s,
         substring(t, least(a, b) + 1, greatest(a, b) - least(a, b)) AS m FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN least(a, b) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN greatest(a, b) - least(a, b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""

OP13 = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS alike,
         list_inner_product(a.v, r.v)::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), inside AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT alike AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM inside WHERE rank <= 10
"""

LLM_ORACLE = {
    "op5_line_dedup": OP5,
    "op5_passage_dedup": OP5,
    "op6_decontamination": OP6,
    "op7_ngram_join": OP7,
    "op8_pii": OP8,
    "op9_factor_dedup": OP9,
    "op10_quality_rules": OP10,
    "op11_fingerprints": OP11,
    "op12_fill_in_middle": OP12,
    "op13_hard_negatives": OP13,
}
