"""SQL that gives the rows of the queries whose method SQL can express on whole tables."""

from __future__ import annotations

from . import quality_rules as rules

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ITEM_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def decontaminate_sql(size: int = 10) -> str:
    return f"""
    WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS w FROM benchmark),
    bi AS (SELECT item, w, least({size}, len(w)) AS n, unnest(range(1, len(w) - least({size}, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
    bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bi),
    di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n),
    dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM di),
    hits AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.n = bw.n AND dw.s = bw.s),
    places AS (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits),
    counted AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN counted c ON d.doc_id = c.doc_id LEFT JOIN named x ON d.doc_id = x.doc_id"""


def quality_sql(max_class: float = 0.12, allowance: float = 1.1, trim: float = 0.2, max_word: float = 0.6, min_classes: int = 50, min_common: int = 100) -> str:
    listed = sorted({w for ws in rules.COMMON_WORDS.values() for w in ws})
    words = ", ".join(f"'{w}'" for w in listed)
    langs = ", ".join(f"'{k}'" for k in rules.COMMON_WORDS)
    blank = r"\x20\x09-\x0D"
    counts = ", ".join(f"""length(t) - length(regexp_replace(t, '[{c.replace("'", "''")}]+', '', 'g')) AS c_{k}""" for k, c in rules.CLASSES.items())
    rest = " - ".join(f"c_{k}" for k in rules.CLASSES)
    listed_counts = ", ".join(f"c_{k}" for k in rules.CLASSES)

    def distance(p: str, q: str) -> str:
        term = "(CASE WHEN x[1] > 0 THEN x[1] * log2(2 * x[1] / (x[1] + x[2])) ELSE 0 END) + (CASE WHEN x[2] > 0 THEN x[2] * log2(2 * x[2] / (x[1] + x[2])) ELSE 0 END)"
        return f"sqrt(greatest(list_sum([{term} FOR x IN list_zip({p}, {q})]) / 2, 0.0))"

    def means(name: str, source: str) -> str:
        return f"""
    {name}_c AS (SELECT lang, list(m ORDER BY i) AS v FROM (SELECT lang, i, avg(x) AS m FROM (SELECT lang, unnest(classes) AS x, unnest(range(len(classes))) AS i FROM {source}) GROUP BY ALL) GROUP BY lang),
    {name}_w AS (SELECT lang, list(m ORDER BY i) AS v FROM (SELECT lang, i, avg(x) AS m FROM (SELECT lang, unnest(common) AS x, unnest(range(len(common))) AS i FROM {source}) GROUP BY ALL) GROUP BY lang)"""

    return f"""
    WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^{blank}]+') AS w FROM documents),
    windows AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM windows) WHERE n > 1),
    repeated AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + 3)) FROM again) GROUP BY doc_id),
    counted AS (SELECT doc_id, lang, t, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^{blank}]')] AS lines,
      [lower(x) FOR x IN w IF lower(x) IN ({words})] AS c, {counts} FROM t),
    shares AS (SELECT *, CASE WHEN length(t) > 0 THEN [x::DOUBLE / length(t) FOR x IN [{listed_counts}, length(t) - {rest}]] ELSE [0.0::DOUBLE FOR x IN range({len(rules.CLASSES) + 1})] END AS classes,
      CASE WHEN n_words > 0 THEN list_append([len([y FOR y IN c IF y = k])::DOUBLE / n_words FOR k IN [{words}]], (n_words - len(c))::DOUBLE / n_words) ELSE [0.0::DOUBLE FOR x IN range({len(listed) + 1})] END AS common FROM counted),
    long AS (SELECT * FROM shares WHERE lang IN ({langs}) AND n_words >= {min_common}),{means("first", "long")},
    near AS (SELECT l.* FROM long l WHERE (SELECT min({distance("l.classes", "f.v")}) FROM first_c f) <= {trim}),{means("second", "near")},
    dist AS (SELECT s.*, (SELECT min({distance("s.classes", "f.v")}) FROM second_c f) AS dc, (SELECT min({distance("s.common", "f.v")}) FROM second_w f) AS dw FROM shares s),
    final AS (SELECT d.doc_id, n_words, word_chars, c_symbol AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words, dc, dw,
      n_words < 50 OR 100 * coalesce(r.n, 0) > 50 * n_words AS base_failed FROM dist d LEFT JOIN repeated r ON d.doc_id = r.doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
      NOT base_failed AND NOT ((n_words >= {min_classes} AND dc > {max_class} + {allowance} / sqrt(n_words)) OR (n_words >= {min_common} AND dw > {max_word})) AS kept FROM final"""
