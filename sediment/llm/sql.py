"""The queries in DuckDB's SQL, where it can express them."""

from __future__ import annotations

from sediment.llm.licenses import EQUIVALENT, KNOWN

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w,
         row_number() OVER () AS row_id
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), grams AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, p, p + least(len(w), 10) - 1) AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM items WHERE len(w) > 0)
), places AS (
  SELECT row_id, p, l.n AS n, list_slice(w, p, p + l.n - 1) AS gram
  FROM (SELECT row_id, w, unnest(range(1, len(w) + 1)) AS p FROM words), (SELECT DISTINCT n FROM grams) AS l
  WHERE p + l.n - 1 <= len(w)
), hits AS (
  SELECT row_id, p, places.n, item_id FROM places JOIN grams USING (gram)
), covered AS (
  SELECT row_id, count(DISTINCT q) AS n_hit
  FROM (SELECT row_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT row_id, p, n FROM hits)) GROUP BY row_id
), found AS (
  SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_id, CAST(item_id AS VARCHAR) AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (row_id) LEFT JOIN found USING (row_id)
"""

# Counts and verdicts of op4, with a host's prior fitted as in the operator.
RULES = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "dup_lines": "100 * n_dup_lines > 40 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}


def quality_cte() -> str:
    k = ", ".join(f"sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS k_{r}" for r, c in RULES.items())
    m = ", ".join(f"avg(k_{r} / n) AS m_{r}, var_pop(k_{r} / n) - avg(k_{r} / n * (1 - k_{r} / n) / n) AS v_{r}" for r in RULES)
    s = ", ".join(
        f"m_{r}, CASE WHEN v_{r} > 0 THEN least(greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 1), 1e6) ELSE 1e6 END AS s_{r}"
        for r in RULES
    )
    bad = " OR ".join(f"(k_{r} + m_{r} * s_{r}) / (n + s_{r}) > 0.9" for r in RULES)
    return f"""
split AS (
  SELECT row_number() OVER () AS row_id, *,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT row_id, p, w[p] AS a, w[p + 1] AS b, w[p + 2] AS c
  FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS p FROM split)
), repeated AS (
  SELECT row_id, count(DISTINCT q) AS n FROM (
    SELECT row_id, unnest([p, p + 1, p + 2]) AS q
    FROM (SELECT row_id, p, count(*) OVER (PARTITION BY row_id, a, b, c) AS k FROM windows) WHERE k > 1
  ) GROUP BY row_id
), counted AS (
  SELECT split.*, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM split LEFT JOIN repeated USING (row_id)
), hosts AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS n, {k} FROM counted WHERE source IS NOT NULL GROUP BY source
), prior AS (SELECT {s} FROM (SELECT {m} FROM hosts)
), bad AS (SELECT source FROM hosts, prior WHERE {bad}
), judged AS (
  SELECT *, {RULES["short"]} OR {RULES["repeats"]} AS base_failed,
         NOT ({RULES["short"]} OR {RULES["repeats"]}) AND (source IS NULL OR source NOT IN (SELECT source FROM bad)) AS kept
  FROM counted
)"""


OP4 = f"""
WITH {quality_cte()}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

OP10 = """
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS r, row_number() OVER () AS row_id
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w
  FROM sized GROUP BY source
), upward AS (
  SELECT *, sum(w) OVER () - coalesce(sum(w) OVER up, 0) AS left_w,
         sum(source_size) OVER () - coalesce(sum(cap) OVER up, 0) AS left_b
  FROM sources
  WINDOW up AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, CAST(cap AS DOUBLE) * CAST(left_w AS DOUBLE) < CAST(left_b AS DOUBLE) * w AS capped FROM upward
), free AS (
  SELECT CAST(sum(source_size) - coalesce(sum(CASE WHEN capped THEN cap END), 0) AS DOUBLE) AS free_b,
         CAST(sum(CASE WHEN NOT capped THEN w END) AS DOUBLE) AS free_w
  FROM marked
), targets AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE) ELSE least(free_b / free_w * w, CAST(cap AS DOUBLE)) END AS target
  FROM marked, free
), placed AS (
  SELECT row_id, doc_id, d.source, size, source_size, target,
         sum(size) OVER (PARTITION BY d.source ORDER BY r, doc_id NULLS LAST, size, row_id) AS upto
  FROM sized AS d JOIN targets AS t ON d.source IS NOT DISTINCT FROM t.source
), times AS (
  SELECT *, e * source_size + upto AS pos, CAST(e * source_size + upto AS DOUBLE) / target AS v
  FROM placed, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0 AND target > 0
), cut AS (
  SELECT row_id, count(*) AS n FROM (
    SELECT row_id, sum(size) OVER (ORDER BY v, source IS NOT NULL, source, pos ROWS UNBOUNDED PRECEDING) AS upto FROM times
  ) WHERE upto <= (SELECT sum(size) FROM sized) GROUP BY row_id
)
SELECT doc_id, size, source_size, target, CAST(size * coalesce(n, 0) AS BIGINT) AS taken
FROM placed LEFT JOIN cut USING (row_id)
"""



def canonical_sql(column: str) -> str:
    out = f"regexp_replace(lower({column}), '(^|\\n)[ \\t]*(copyright|\\(c\\)|©)[^\\n]*', ' ', 'g')"
    for one, other in EQUIVALENT:
        out = f"replace({out}, '{one}', '{other}')"
    out = f"regexp_replace({out}, '\\b(version|ver|v)[. ]*([0-9])', '\\2', 'g')"
    return f"trim(regexp_replace({out}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' ')"


def op2() -> str:
    known = ", ".join(f"('{license}', '{text}')" for license, text in KNOWN)
    return f"""
WITH given AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_id FROM documents
), known AS (
  SELECT DISTINCT license, {canonical_sql("text")} AS form FROM (VALUES {known}) AS v(license, text)
), units AS (
  SELECT row_id, 0 AS no, text AS unit FROM given
  UNION ALL
  SELECT row_id, no, parts[no] FROM (
    SELECT row_id, parts, unnest(range(1, len(parts) + 1)) AS no FROM (SELECT row_id, string_split(text, chr(10)) AS parts FROM given)
  )
), hits AS (SELECT DISTINCT row_id, no, license FROM units JOIN known ON {canonical_sql("unit")} = form AND form <> ''
), summed AS (
  SELECT row_id, string_agg(DISTINCT license, ',' ORDER BY license) FILTER (no = 0) AS w,
         string_agg(DISTINCT license, ',' ORDER BY license) FILTER (no > 0) AS l,
         count(DISTINCT no) FILTER (no > 0) AS n
  FROM hits GROUP BY row_id
)
SELECT doc_id, coalesce(w, '') AS whole_licenses, coalesce(l, '') AS line_licenses, CAST(coalesce(n, 0) AS BIGINT) AS n_lines,
       w IS NOT NULL OR l IS NOT NULL AS licensed
FROM given LEFT JOIN summed USING (row_id)
"""


OP8 = f"""
WITH given AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS parts, row_number() OVER (ORDER BY doc_id NULLS LAST) AS row_id
  FROM documents
), lines AS (
  SELECT row_id, no, parts[no] AS line,
         regexp_extract_all(translate(parts[no], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM (SELECT row_id, parts, unnest(range(1, len(parts) + 1)) AS no FROM given)
), distinct_lines AS (
  SELECT w, min((row_id, no)) AS at, row_number() OVER () AS line_id FROM lines WHERE len(w) > 0 GROUP BY w
), tokens AS (
  SELECT DISTINCT line_id, token FROM (SELECT line_id, unnest(w) AS token FROM distinct_lines)
), sizes AS (SELECT line_id, count(*) AS n FROM tokens GROUP BY line_id
), common AS (
  SELECT a.line_id AS a, b.line_id AS b, count(*) AS c FROM tokens AS a JOIN tokens AS b USING (token)
  WHERE a.line_id <> b.line_id GROUP BY ALL
), matched AS (
  SELECT DISTINCT a FROM common JOIN sizes AS x ON x.line_id = a JOIN sizes AS y ON y.line_id = b
  JOIN distinct_lines AS p ON p.line_id = a JOIN distinct_lines AS q ON q.line_id = b
  WHERE 9 * c >= 4 * (x.n + y.n) AND q.at < p.at
), gone AS (
  SELECT row_id, no FROM lines JOIN distinct_lines AS d USING (w)
  WHERE (row_id, no) <> d.at OR line_id IN (SELECT a FROM matched)
), kept AS (
  SELECT row_id, string_agg(line, chr(10) ORDER BY no) AS text, count(*) AS n
  FROM lines LEFT JOIN gone USING (row_id, no) WHERE gone.no IS NULL GROUP BY row_id
)
SELECT doc_id, CAST(coalesce(len(parts), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(parts), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
       CASE WHEN given.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM given LEFT JOIN kept USING (row_id)
"""


# Phrases of up to three words, counted as texts.
OP12 = f"""
WITH pieces AS (
  SELECT lang, doc, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc, {LOWER} AS t FROM documents)
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS p FROM words
), grams AS (
  SELECT lang, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS phrase
  FROM places, (VALUES (1), (2), (3)) AS sizes(k) WHERE p + k - 1 <= len(w)
), f AS (
  SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY lang, k, phrase
), totals AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), cuts AS (
  SELECT lang, phrase, n AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k > 1 AND n >= 10
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.n AS l, t.n AS r,
         CAST((CAST(c.a AS HUGEINT) * c.a * 1000000) // (CAST(h.n AS HUGEINT) * t.n) AS BIGINT) AS score
  FROM cuts AS c
  JOIN f AS h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(c.w, 1, c.cut), ' ')
  JOIN f AS t ON t.lang = c.lang AND t.phrase = array_to_string(list_slice(c.w, c.cut + 1, len(c.w)), ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, inner_phrase, max(n) AS around FROM (
    SELECT lang, n, array_to_string(list_slice(string_split(phrase, ' '), i, i + 1), ' ') AS inner_phrase
    FROM f, (VALUES (1), (2)) AS starts(i) WHERE k = 3 AND n >= 10)
  GROUP BY lang, inner_phrase
), left_over AS (
  SELECT x.* FROM lowest AS x LEFT JOIN inside AS y ON y.lang = x.lang AND y.inner_phrase = x.phrase
  WHERE y.around IS NULL OR 100 * y.around < 50 * x.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over
) JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op2_license_scan": op2(), "op4_quality_rules": OP4, "op8_line_dedup": OP8, "op10_mixing": OP10, "op12_collocations": OP12}
