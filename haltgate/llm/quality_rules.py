"""Quality rules: a threshold table compiled into one Spark projection.

Only SQL functions: the measures of a text, then the verdict of each row of the
table, are columns. Repeated windows of words are found inside the row by
hash, so nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# The most frequent function words of the four languages.
STOP_WORDS = (
    "the of and to in a is that for it as was with be by on this are at from not or an "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als es "
    "de la le et les un du une que est pour dans qui par sur pas au avec en "
    "el y los se las del por con no una su para al lo"
).split()

MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEATED_PERCENT = 30

#: (measure, least, most); None: no bound. A document is kept if every row holds.
THRESHOLDS: tuple[tuple[str, float | None, float | None], ...] = (
    ("mean_word_chars", 2.0, 12.0),
    ("symbol_ratio", None, 0.1),
    ("exclamation_ratio", None, 0.3),
    ("stop_word_ratio", 0.05, None),
    ("duplicate_line_ratio", None, 0.4),
)

SPACES = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def _count(text: Column, kept: str) -> Column:
    """Characters of a class: what is left without all others."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", ""))


def repeated_words(words: Column, window: int = WINDOW_WORDS) -> Column:
    """Words inside windows of ``window`` words that occur twice or more in the array,
    the first included. Windows are compared by 64-bit hash; only texts in which one
    repeats are sorted."""
    none = F.lit(0).cast("long")

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (window - 1)), lambda i: F.xxhash64(F.slice(w, i, window)))

    def covered(h: Column) -> Column:
        placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def starts(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.array_sort(F.transform(F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))

        begin = F.struct(none.alias("n"), F.lit(-window).alias("last"))
        total = F.aggregate(let(placed, starts), begin, lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(window), i - a["last"])).cast("long").alias("n"), i.alias("last")))
        return total["n"]

    counted = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))
    return F.when(F.size(words) < window, none).otherwise(let(let(words, hashes), counted))


def measures(text: Column, words: Column, lines: Column) -> dict[str, Column]:
    """Named counts of a text; ``words`` and ``lines`` (those with a word) are its arrays."""
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": _count(text, "#*$%&|<>").cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeated_words(words),
        "n_exclamations": _count(text, "!").cast("long"),
        "n_stop_words": F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long"),
        "n_lines": F.size(lines).cast("long"),
    }


def ratios() -> dict[str, Column]:
    """The measures of the threshold table, from the counts."""
    per = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbol_ratio": per("n_symbols", "n_words"),
        "exclamation_ratio": per("n_exclamations", "n_words"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "duplicate_line_ratio": per("n_dup_lines", "n_lines"),
    }


def compiled(thresholds=THRESHOLDS) -> Column:
    """The table as one condition."""
    ratio, verdict = ratios(), F.lit(True)
    for name, least, most in thresholds:
        if least is not None:
            verdict = verdict & (ratio[name] >= least)
        if most is not None:
            verdict = verdict & (ratio[name] <= most)
    return verdict


def judge(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents' columns under ``doc``, the counts, ``base_failed`` and ``kept``.

    A null or empty text has no words and fails. Repeated rows are judged each; a
    null doc_id stays null; no column of the input is read but ``text``; an empty
    table gives no rows."""
    doc = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    text = F.coalesce(F.col("doc.text").cast("string"), F.lit(""))
    arrays = doc.select("doc", text.alias("t"), F.array_remove(F.split(text, SPACES), "").alias("words"),
                        F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"))
    counts = measures(F.col("t"), F.col("words"), F.col("lines"))
    counted = arrays.select("doc", *[c.alias(name) for name, c in counts.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & compiled(thresholds))


def kept_documents(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, thresholds).where("kept").select("doc.*")


def oracle_sql(thresholds=THRESHOLDS) -> str:
    """The same verdicts for DuckDB."""
    ratio = {"mean_word_chars": "word_chars / greatest(n_words, 1)", "symbol_ratio": "n_symbols / greatest(n_words, 1)",
             "exclamation_ratio": "n_exclamations / greatest(n_words, 1)", "stop_word_ratio": "n_stop_words / greatest(n_words, 1)",
             "duplicate_line_ratio": "n_dup_lines / greatest(n_lines, 1)"}
    rules = " AND ".join(f"{ratio[m]} {op} {bound}" for m, least, most in thresholds for op, bound in ((">=", least), ("<=", most)) if bound is not None)
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
a AS (
  SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
windows AS (
  SELECT row_id, unnest(range(1, len(words) - {WINDOW_WORDS} + 2)) AS i,
    unnest(list_transform(range(1, len(words) - {WINDOW_WORDS} + 2), lambda i: words[i:i + {WINDOW_WORDS - 1}])) AS w
  FROM a WHERE len(words) >= {WINDOW_WORDS}),
twice AS (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, w) AS n FROM windows),
spans AS (SELECT row_id, i, lag(i) OVER (PARTITION BY row_id ORDER BY i) AS before FROM twice WHERE n > 1),
repeats AS (SELECT row_id, sum(least({WINDOW_WORDS}, i - coalesce(before, i - {WINDOW_WORDS}))) AS n FROM spans GROUP BY row_id),
c AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
    length(regexp_replace(t, '[^!]+', '', 'g'))::BIGINT AS n_exclamations,
    len(list_filter(words, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words, len(lines)::BIGINT AS n_lines
  FROM a LEFT JOIN repeats USING (row_id)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND {rules} AS kept FROM f"""
