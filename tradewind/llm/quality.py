"""Quality rules: a threshold table compiled into one projection.

Every rule compares a count with a percentage of another count, in integers, so no
rounding decides about a document. The counts are built-in expressions over the whole
text; there is no user function and no shuffle.

Defined cases: a NULL or empty text has no words and fails the base rule; other columns
of the input, also ones named like the results, are kept under their name with `_given`
where they would clash; repeated rows are judged each by itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import clear_of

WHITE_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Frequent function words of the languages the rules are meant for.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "that", "it", "for", "was", "on", "with", "as", "be", "by", "are", "this",
    "de", "la", "le", "et", "les", "en", "des", "un", "du", "une", "que", "est", "pour", "par",
    "der", "die", "und", "den", "von", "zu", "das", "sich", "mit", "auf", "ist", "im", "nicht",
    "el", "y", "los", "las", "se", "del", "por", "con", "no", "una", "su", "para", "al",
)


@dataclass(frozen=True)
class Rule:
    """Reject where 100 * `count` is above (or below) `percent` * `base`, for texts of `least_words` words or more."""

    name: str
    count: str
    base: str
    percent: int
    below: bool = False
    least_words: int = 0

    def fails(self) -> Column:
        share, limit = F.col(self.count) * 100, F.col(self.base) * self.percent
        bad = share < limit if self.below else share > limit
        return bad & (F.col("n_words") >= self.least_words)


BASE_RULES = (
    Rule("too_short", "n_words", "ten", 100, below=True),
    Rule("repeated_words", "n_repeat_words", "n_words", 20),
)
RULES = (
    Rule("symbols", "n_symbols", "n_words", 10),
    Rule("long_words", "word_chars", "n_words", 1500),
    Rule("short_words", "word_chars", "n_words", 200, below=True),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 50),
    Rule("few_stop_words", "n_stop_words", "n_words", 3, below=True, least_words=100),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words", "n_repeat_words")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add COUNTS to `docs`, all BIGINT."""
    kept = clear_of(docs, *COUNTS, "_text", "_words", "_lines", "_hashes", "_windows", "_sorted", "_places").columns
    docs = clear_of(docs, *COUNTS, "_text", "_words", "_lines", "_hashes", "_windows", "_sorted", "_places")
    blank = " " * len(WHITE_SPACE)
    # Columns that a later step uses several times stand in a projection of their own:
    # the optimizer then keeps them apart and each is computed once.
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    df = df.withColumns({
        "_words": F.array_remove(F.split(F.translate("_text", WHITE_SPACE, blank), " "), ""),
        "_lines": F.filter(F.split("_text", "\n"), lambda line: F.length(F.ltrim(F.translate(line, WHITE_SPACE, blank))) > 0),
    })
    df = df.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.translate("_text", WHITE_SPACE, "")).cast("bigint"),
        "n_symbols": (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("bigint"),
        "n_lines": F.size("_lines").cast("bigint"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_stop_words": F.size(F.filter("_words", lambda word: F.lower(word).isin(*STOP_WORDS))).cast("bigint"),
        "_hashes": F.transform("_words", lambda word: F.xxhash64(word)),
    })
    df = df.withColumn("_windows", F.transform(
        F.slice("_hashes", 1, F.greatest(F.col("n_words").cast("int") - (WINDOW - 1), F.lit(0))),
        lambda first, i: F.xxhash64(first, *[F.get("_hashes", i + step) for step in range(1, WINDOW)])))
    # Only texts with a repeated window pay for the sort.
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"),
        F.array_sort(F.transform("_windows", lambda window, i: F.struct(window.alias("w"), i.alias("i"))))))
    df = df.withColumn("_places", F.array_sort(F.transform(F.filter(
        "_sorted", lambda cell, j: F.coalesce(
            (F.get("_sorted", j - 1)["w"] == cell["w"]) | (F.get("_sorted", j + 1)["w"] == cell["w"]),
            F.get("_sorted", j - 1)["w"] == cell["w"], F.get("_sorted", j + 1)["w"] == cell["w"], F.lit(False))),
        lambda cell: cell["i"])))
    # A window covers its words up to where the next repeated one begins.
    covered = F.aggregate(
        F.transform("_places", lambda place, j: F.least(
            F.lit(WINDOW), F.coalesce(F.get("_places", j + 1) - place, F.lit(WINDOW)))),
        F.lit(0), lambda total, step: total + step)
    counts = df.select(*kept, *COUNTS[:-1], F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))
    # The counts go through a generator of one row. A filter on them cannot be pushed below
    # it, where the optimizer would put their expressions in the place of the columns and
    # have every list computed again for each of its elements.
    return counts.select(*kept, F.inline(F.array(F.struct(*COUNTS))))


def apply_rules(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: tuple[Rule, ...] = BASE_RULES, text: str = "text",
) -> DataFrame:
    """Add COUNTS, `base_failed`, `failed_rules` (names in table order) and `kept` to `docs`."""
    counted = text_counts(clear_of(docs, "base_failed", "failed_rules", "kept", "ten"), text).withColumn("ten", F.lit(10))
    base_failed = F.lit(False)
    for rule in base:
        base_failed = base_failed | rule.fails()
    failed = F.array_compact(F.array(*[F.when(rule.fails(), F.lit(rule.name)) for rule in (*base, *rules)]))
    return (
        counted.withColumns({"base_failed": base_failed, "failed_rules": failed})
        .withColumn("kept", F.size("failed_rules") == 0).drop("ten")
    )


def op9_quality_rules(docs: DataFrame) -> DataFrame:
    return apply_rules(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
OP9_SQL = f"""
WITH base AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
    FROM documents),
windows AS (
    SELECT r, i, w[i:i + 4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM base)),
repeated AS (SELECT r, i FROM (SELECT r, i, COUNT(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
covered AS (
    SELECT r, CAST(SUM(LEAST(5, COALESCE(next - i, 5))) AS BIGINT) AS n_repeat_words
    FROM (SELECT r, i, LEAD(i) OVER (PARTITION BY r ORDER BY i) AS next FROM repeated) GROUP BY r),
counts AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
           CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(l) AS BIGINT) AS n_lines,
           CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
           len(list_filter(w, lambda x: lower(x) IN ({', '.join(f"'{word}'" for word in STOP_WORDS)}))) AS n_stop_words,
           COALESCE(n_repeat_words, 0) AS n_repeat_words
    FROM base LEFT JOIN covered USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * word_chars > 1500 * n_words
            OR 100 * word_chars < 200 * n_words OR 100 * n_dup_lines > 50 * n_lines
            OR (n_words >= 100 AND 100 * n_stop_words < 3 * n_words)) AS kept
FROM judged"""
