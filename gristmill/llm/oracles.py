"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import quality

_GAP = r"[\x20\x09-\x0D]+"
_WORDS = "list_filter(string_split_regex({}, '" + _GAP + "'), lambda s: s <> '')"

_RATIOS = {
    "n_words": "n_words",
    "repeat_ratio": "coalesce(n_repeat_words / nullif(n_words, 0), 0)",
    "mean_word_chars": "coalesce(word_chars / nullif(n_words, 0), 0)",
    "symbol_ratio": "coalesce(n_symbols / nullif(n_words, 0), 0)",
    "stutter_ratio": "coalesce(n_stutters / nullif(n_words, 0), 0)",
    "exclamation_ratio": "coalesce(n_exclaims / nullif(n_words, 0), 0)",
    "dup_line_ratio": "coalesce(n_dup_lines / nullif(n_lines, 0), 0)",
    "bullet_line_ratio": "coalesce(n_bullets / nullif(n_lines, 0), 0)",
    "ellipsis_line_ratio": "coalesce(n_ellipses / nullif(n_lines, 0), 0)",
    "alpha_word_ratio": "coalesce(n_alpha_words / nullif(n_words, 0), 0)",
    "upper_ratio": "coalesce(n_upper / nullif(n_letters, 0), 0)",
    "stop_word_ratio": "coalesce(n_stop_words / nullif(n_words, 0), 0)",
}


def quality_sql(rules: tuple = quality.RULES) -> str:
    """op7: the counts, the base rules, and the threshold table as one condition."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for v in quality.STOP_WORDS.values() for w in v}))
    failed = " OR ".join(f"{_RATIOS[m]} {op} {limit}" for _, m, op, limit in rules)
    return rf"""WITH t AS (SELECT doc_id, row_number() OVER () AS k, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, {_WORDS.format("x")} AS w, list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS l FROM t),
v AS (SELECT k, i, count(*) OVER (PARTITION BY k, v) AS c FROM (SELECT k, unnest(range(1, len(w) - 6)) AS i, unnest(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' '))) AS v FROM w)),
r AS (SELECT k, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n_repeat_words FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nxt FROM v WHERE c > 1) GROUP BY k),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(x, '{_GAP}', '', 'g')) AS word_chars, length(regexp_replace(x, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
  len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
  length(regexp_replace(x, '\P{{L}}+', '', 'g')) AS n_letters, length(regexp_replace(x, '\P{{Lu}}+', '', 'g')) AS n_upper, length(regexp_replace(x, '[^!]+', '', 'g')) AS n_exclaims,
  len(list_filter(l, lambda s: regexp_matches(s, '^\s*[-*•]'))) AS n_bullets, len(list_filter(l, lambda s: regexp_matches(s, '(…|\.\.\.)\s*$'))) AS n_ellipses,
  len(list_filter(w, lambda s: lower(s) IN ({stop}))) AS n_stop_words,
  len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters, len(list_filter(w, lambda s: regexp_matches(s, '\p{{L}}'))) AS n_alpha_words
  FROM w LEFT JOIN r USING (k)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT (base_failed OR {failed}) AS kept FROM b"""


def components_sql(words: int = 3, num: int = 90, den: int = 100) -> str:
    """op4: all pairs that share a shingle, their similarity, and the closure of the links."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    grams = " || ' ' || ".join(f"w[i + {k}]" for k in range(words))
    return f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')")} AS w FROM documents),
h AS (SELECT doc_id, CASE WHEN len(w) >= {words} THEN list_distinct(list_transform(range(1, len(w) - {words - 2}), lambda i: {grams})) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS h FROM w),
n AS (SELECT doc_id, len(h) AS n, CASE WHEN len(h) > 0 THEN min(doc_id) OVER (PARTITION BY md5(array_to_string(list_sort(h), chr(10)))) ELSE doc_id END AS class_id FROM h),
s AS (SELECT doc_id, unnest(h) AS s FROM h),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE {den} * c >= {num} * (x.n + y.n - c)),
r AS (SELECT a AS node, b AS seen FROM e UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
m AS (SELECT node, min(seen) AS low FROM r GROUP BY node), k AS (SELECT a, count(*) AS links FROM e GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, class_id, coalesce(links, 0)::BIGINT AS n_links, least(doc_id, coalesce(low, doc_id)) AS component_id FROM n LEFT JOIN m ON doc_id = node LEFT JOIN k ON doc_id = a"""


def warc_sql() -> str:
    """op3: the records that a round trip must give; base32 is taken five bits at a time from the hex digest."""
    group = "('0x' || substr(h, g * 5 + 1, 5))::BIGINT"
    four = f"list_reduce(list_transform([15, 10, 5, 0], lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((({group}) >> s) & 31) + 1, 1)), lambda a, b: a || b)"
    return f"""WITH p AS (SELECT page_id, coalesce(html, '') AS x, sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY sha256(coalesce(html, ''))) AS top FROM pages)
SELECT page_id, strlen(x)::BIGINT AS payload_bytes, list_reduce(list_transform(range(8), lambda g: {four}), lambda a, b: a || b) AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM p"""
