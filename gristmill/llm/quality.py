"""Quality rules (operator 7): a threshold table compiled into one projection.

Only built-in column functions are used; there is no user function on any path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import names

GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"

#: Frequent function words of the languages that the corpus may hold.
STOP_WORDS = {
    "en": "the be to of and that have with a in is was for on are this by it as or".split(),
    "fr": "le la les de des un une et est que qui dans pour sur avec en du ce pas au".split(),
    "de": "der die das und ist zu den von mit dem ein eine nicht auf im für des sich an es".split(),
    "es": "el la los las de que y en un una es por con para del se no su al como".split(),
}

#: (name, measure, operator, limit): a document fails where measure <operator> limit holds.
RULES: tuple[tuple[str, str, str, float], ...] = (
    ("few_words", "n_words", "<", 20),
    ("repeated_windows", "repeat_ratio", ">", 0.30),
    ("short_words", "mean_word_chars", "<", 2.0),
    ("long_words", "mean_word_chars", ">", 14.0),
    ("symbols", "symbol_ratio", ">", 0.20),
    ("stuttered_words", "stutter_ratio", ">", 0.20),
    ("exclamations", "exclamation_ratio", ">", 0.30),
    ("duplicate_lines", "dup_line_ratio", ">", 0.50),
    ("bullet_lines", "bullet_line_ratio", ">", 0.90),
    ("ellipsis_lines", "ellipsis_line_ratio", ">", 0.50),
    ("no_letters", "alpha_word_ratio", "<", 0.50),
    ("capitals", "upper_ratio", ">", 0.60),
    ("stop_words", "stop_word_ratio", "<", 0.01),
)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _size(pattern: str, text: Column) -> Column:
    """Code points of ``text`` outside of ``pattern``'s matches."""
    return F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(words: Column, window: int) -> Column:
    """Words that lie in some ``window``-word run found twice or more, the first included.

    Equal windows are found by 64-bit hashes. The sort runs only for texts that have any.
    """
    n = F.size(words)
    runs = F.when(n >= window, F.transform(F.sequence(F.lit(1), n - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        keyed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(k: Column) -> Column:
            twin = lambda x, i: (F.get(k, i - 1)["h"] == x["h"]) | (F.get(k, i + 1)["h"] == x["h"])
            return F.sort_array(F.transform(F.filter(k, lambda x, i: F.coalesce(twin(x, i), F.lit(False))), lambda x: x["i"]))

        def total(p: Column) -> Column:
            return F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(window), F.coalesce(F.get(p, i + 1) - x, F.lit(window)))), F.lit(0).cast("bigint"), lambda a, x: a + x)

        # A one-element transform binds an intermediate array to a name, so that it is made once.
        return F.get(F.transform(F.transform(F.array(keyed), starts), total), 0)

    return F.get(F.transform(F.array(runs), lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("bigint"))), 0)


def measures(text: Column, words: Column, lines: Column, window: int, stop: list[str]) -> dict[str, Column]:
    """Raw counts by name. ``lines``: the \\n-split lines that hold a word."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": _size(GAP, text).cast("long"),
        "n_symbols": _size(r"[^#*$%&|<>]+", text).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words, window).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_letters": _size(r"\P{L}+", text).cast("long"),
        "n_upper": _size(r"\P{Lu}+", text).cast("long"),
        "n_exclaims": _size("[^!]+", text).cast("long"),
        "n_bullets": F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•]"))).cast("long"),
        "n_ellipses": F.size(F.filter(lines, lambda x: x.rlike(r"(…|\.\.\.)\s*$"))).cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long"),
        "n_stutters": F.size(F.filter(words, lambda w, i: F.coalesce(F.get(words, i - 1) == w, F.lit(False)))).cast("long"),
        "n_alpha_words": F.size(F.filter(words, lambda w: w.rlike(r"\p{L}"))).cast("long"),
    }


def ratios(counts: str) -> dict[str, Column]:
    """The measures that rules name, from the struct column of counts."""
    c = lambda name: F.col(f"{counts}.{name}")
    return {
        "n_words": c("n_words"),
        "repeat_ratio": _ratio(c("n_repeat_words"), c("n_words")),
        "mean_word_chars": _ratio(c("word_chars"), c("n_words")),
        "symbol_ratio": _ratio(c("n_symbols"), c("n_words")),
        "stutter_ratio": _ratio(c("n_stutters"), c("n_words")),
        "exclamation_ratio": _ratio(c("n_exclaims"), c("n_words")),
        "dup_line_ratio": _ratio(c("n_dup_lines"), c("n_lines")),
        "bullet_line_ratio": _ratio(c("n_bullets"), c("n_lines")),
        "ellipsis_line_ratio": _ratio(c("n_ellipses"), c("n_lines")),
        "alpha_word_ratio": _ratio(c("n_alpha_words"), c("n_words")),
        "upper_ratio": _ratio(c("n_upper"), c("n_letters")),
        "stop_word_ratio": _ratio(c("n_stop_words"), c("n_words")),
    }


def score(docs: DataFrame, rules: tuple = RULES, window: int = 8, text_col: str = "text", stop_words: dict[str, list[str]] = STOP_WORDS, out: str = "quality_rules") -> DataFrame:
    """``docs`` with a struct column ``out``: the counts, ``failed`` (names of the rules that
    reject, in table order), ``base_failed`` and ``kept``.

    Rows are kept as they are, repeated ones too; a null text has no words and fails
    ``few_words``; a column named ``out`` is replaced, all others are untouched whatever their
    names. Every measure covers the whole text. No shuffle, no Python.
    """
    stop = sorted({w for v in stop_words.values() for w in v})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    t, w, lines, m = (names.free(docs, x) for x in ("t", "w", "l", "m"))
    base = docs.select(*names.own(docs), text.alias(t))
    base = base.select("*", F.filter(F.split(t, GAP), lambda x: x != "").alias(w), F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)).alias(lines))
    counts = F.struct(*[c.alias(k) for k, c in measures(F.col(t), F.col(w), F.col(lines), window, stop).items()])
    # Generated, not projected: the optimizer would copy the counts into every rule that names them.
    counted = base.select(*names.own(docs, out), F.explode(F.array(counts)).alias(m))
    return counted.select(*names.own(counted, m), judged(m, counted.schema[m].dataType.fieldNames(), rules).alias(out))


def judged(counts: str, fields: list[str], rules: tuple) -> Column:
    """The struct of counts, failed rules and verdicts from a struct column of counts."""
    known, hits = ratios(counts), []
    for name, measure, op, limit in rules:
        hits.append((name, known[measure] < limit if op == "<" else known[measure] > limit))
    failed = F.filter(F.array(*[F.when(h, F.lit(n)) for n, h in hits]), lambda x: x.isNotNull())
    n, r = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    base = (n < 20) | (100 * r > 30 * n)
    kept = ~reduce(lambda a, b: a | b, [h for _, h in hits], base)
    return F.struct(*[F.col(f"{counts}.{f}").alias(f) for f in fields], failed.alias("failed"), base.alias("base_failed"), kept.alias("kept"))
