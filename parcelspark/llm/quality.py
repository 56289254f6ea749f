"""Quality rules, line first: lines that fail go, then documents that lose too much text."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.columns import covered, let, space_words, squeezed, window_hashes

SYMBOLS = "#*$%&|<>"
#: Notices that pages repeat around their content; a line with one of them is boilerplate.
BOILERPLATE = ["javascript", "cookie", "privacy policy", "terms of use", "terms of service", "sign in", "log in",
               "click here", "all rights reserved", "subscribe", "lorem ipsum"]


@dataclass(frozen=True)
class Rules:
    """Limits of the line rules and of the loss that a document may have."""

    menu_bars: int = 3  # bars in a line of a menu or table
    symbol_share: float = 0.1  # of a line's characters
    one_word_share: float = 0.3  # distinct words to words, in lines of ten words and more
    least_words: int = 4  # shorter lines need not end as a sentence, or hold small letters
    least_left: float = 0.5  # of the document's characters, after the lines that fail


def line_fails(line: Column, again: Column, rules: Rules) -> Column:
    """Whether a line breaks a rule. ``again``: the text has the same line before."""
    symbols = F.length(line) - F.length(F.translate(line, SYMBOLS, ""))
    bars = F.length(line) - F.length(F.replace(line, F.lit("|"), F.lit("")))

    def of_words(words: Column, n: Column) -> Column:
        long = n >= rules.least_words
        return (long & (line == F.upper(line)) & (line != F.lower(line))  # shouting
                | long & ~line.rlike(r"[.!?…:;\"'”»)\]。]( |$)")  # no end of a sentence or clause
                | (n >= 10) & (F.size(F.array_distinct(words)) < rules.one_word_share * n))

    def notices(small: Column) -> Column:
        return reduce(Column.__or__, [F.contains(small, F.lit(x)) for x in BOILERPLATE])

    # expressions inside a lambda are worked out wherever they stand, so words and small letters are bound once a line
    return (
        again
        | (bars >= rules.menu_bars)  # navigation
        | (symbols > 0) & (symbols > rules.symbol_share * F.length(squeezed(line)))
        | let(space_words(line), lambda words: let(F.size(words), lambda n: of_words(words, n)))
        | let(F.lower(line), notices)
    )


def repeat_words(words: Column, size: int = 8) -> Column:
    """Words inside a window of ``size`` words that the text has twice or more, the first one included.

    Windows are compared by 64-bit hash within one text. Texts without a repeat end at the distinct count; in the rest,
    one sort brings equal windows together, so the work is n log n for texts of any length.
    """
    def from_sorted(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1).h == x.h, F.lit(False))
                         | F.coalesce(F.get(s, i + 1).h == x.h, F.lit(False)))
        return covered(F.array_sort(F.transform(twice, lambda x: F.struct(
            x.i.alias("start"), F.lit(size).alias("length")))))

    def from_hashes(hashes: Column) -> Column:
        by_hash = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")) \
            .otherwise(let(by_hash, from_sorted))

    return let(window_hashes(words, size), from_hashes)


def clean_lines(docs: DataFrame, rules: Rules = Rules(), max_repeat_percent: int = 30, least_words: int = 20) -> DataFrame:
    """One row per row of ``docs`` with doc_id, the measures, base_failed, kept, and cleaned (the text of the lines left).

    Null texts are empty; empty ones fail for too few words. Repeated rows and ids each get a row. Only doc_id and text
    are read, so other columns may have any name. Nothing is shuffled.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), space_words(text).alias("words"), F.split(text, "\n", -1).alias("lines"))
    with_words = F.filter("lines", lambda x: squeezed(x) != "")
    # the first place of each line: equal lines sort together, so that "again" needs no look-up
    order = F.array_sort(F.transform("lines", lambda x, i: F.struct(x.alias("line"), i.alias("i"))))
    judged = let(order, lambda s: F.filter(s, lambda x, k: ~line_fails(
        x.line, (squeezed(x.line) != "") & F.coalesce(F.get(s, k - 1).line == x.line, F.lit(False)), rules)))
    left = F.array_sort(F.transform(judged, lambda x: F.struct(x.i.alias("i"), x.line.alias("line"))))
    measured = rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        F.length(squeezed(F.col("text"))).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(with_words, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("words")).alias("n_repeat_words"),
        F.array_join(F.transform(left, lambda x: x.line), "\n").alias("cleaned"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    enough = F.length(squeezed(F.col("cleaned"))) >= rules.least_left * F.col("word_chars")
    return measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return clean_lines(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                    "base_failed", "kept")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[ \x09-\x0D]+'), lambda w: w <> '') AS words,
    string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), starts AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram FROM d, unnest(range(1, len(words) - 6)) AS t(i)
), twice AS (
  SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM starts) WHERE n > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, unnest(range(8)) AS t(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, line, regexp_replace(line, '[ \x09-\x0D]+', '', 'g') AS bare,
    list_filter(string_split_regex(line, '[ \x09-\x0D]+'), lambda w: w <> '') AS words,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY k) > 1 AS again
  FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS k FROM d)
), judged AS (
  SELECT *, (bare <> '' AND again) OR length(line) - length(replace(line, '|', '')) >= 3
    OR length(line) - length(regexp_replace(line, '[#*$%&|<>]', '', 'g')) > 0.1::DOUBLE * length(bare)
    OR (len(words) >= 4 AND line = upper(line) AND line <> lower(line))
    OR (len(words) >= 4 AND NOT regexp_matches(line, '[.!?…:;"''”»)\]。]( |$)'))
    OR (len(words) >= 10 AND len(list_distinct(words)) < 0.3::DOUBLE * len(words))
    OR regexp_matches(lower(line), 'javascript|cookie|privacy policy|terms of use|terms of service|sign in|log in|click here|all rights reserved|subscribe|lorem ipsum')
    AS fails
  FROM lines
), by_line AS (
  SELECT doc_id, count(*) FILTER (WHERE bare <> '' AND again) AS n_dup_lines,
    coalesce(sum(length(bare)) FILTER (WHERE NOT fails), 0) AS left_chars
  FROM judged GROUP BY doc_id
), measured AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[ \x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, left_chars
  FROM d JOIN by_line USING (doc_id) LEFT JOIN repeated USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND left_chars >= 0.5::DOUBLE * word_chars AS kept
FROM measured
"""
