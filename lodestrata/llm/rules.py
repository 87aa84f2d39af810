"""Quality rules: a table of thresholds compiled into column expressions, evaluated without user functions.

Words are the runs of characters other than space and 9 to 13. Counts are of whole texts, exact but for hashes of
64 bits that stand for the windows (two different windows of a text collide with a chance of n**2 / 2**65):

- word_chars: code points in words; n_symbols: characters of ``#*$%&|<>``;
- n_dup_lines: lines with a word that equal an earlier one;
- n_repeat_words: words covered by 3-word windows that occur at least twice in the text, the first included.

A text fails the base rules with fewer than 50 words or if over half of its words repeat. Otherwise the threshold
table judges ratios of these counts, stop words (in lower case or with a capital), upper-case letters and lines. A text is kept if every ratio lies
within its row's bounds.

Windows are compared by the 64-bit hashes of their three words, sorted with their places: n log n in the length of
a text, and each text stays in its row, so no key gathers rows.

Defined results: a null or empty text has zero counts, fails the base rules and isn't kept. Rows that repeat, ties
and extra columns change nothing: each row is judged by its own text. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"

#: Common function words of English, German, French and Spanish.
STOP_WORDS = """
the of and to in is that was for on are with as be at by this it or an from not have has which
der die das und ist nicht ein eine mit von zu den im für auf dem des sich als auch es an
le la les de des et un une est que qui dans pour par sur au pas ne du en avec il
el los las del y que en un una es por con para se no su al lo como más
""".split()
#: As they are, and as sentences begin.
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})


@dataclass(frozen=True)
class Rule:
    """A ratio, by SQL over the counts, and the closed bounds within which a text is kept."""

    name: str
    ratio: str
    low: float
    high: float


#: The production table.
TABLE = (
    Rule("mean_word_length", "word_chars / n_words", 2.0, 14.0),
    Rule("symbol_ratio", "n_symbols / n_words", 0.0, 0.1),
    Rule("stop_word_ratio", "n_stop_words / n_words", 0.05, 1.0),
    Rule("upper_ratio", "n_upper / word_chars", 0.0, 0.25),
    Rule("dup_line_ratio", "n_dup_lines / n_lines", 0.0, 0.7),
)


def _size(array: Column) -> Column:
    return F.size(array).cast("long")


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs' doc_id with every count that the rules use."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = docs.select("doc_id", whole.alias("t")).select(
        "doc_id", "t", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines")
    )
    hashed = words.select(
        "doc_id",
        _size(F.col("w")).alias("n_words"),
        _without(F.col("t"), SPACE).cast("long").alias("word_chars"),
        (F.length("t") - _without(F.col("t"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length("t") - _without(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
        _size(F.filter("w", lambda x: x.isin(STOP_FORMS))).alias("n_stop_words"),
        _size(F.col("lines")).alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    windows = F.greatest(F.size("h") - 2, F.lit(0))
    pair = F.zip_with(F.slice("h", 1, windows), F.slice("h", 2, windows), lambda a, b: F.xxhash64(a, b))
    hashed = hashed.withColumn("g", F.zip_with(pair, F.slice("h", 3, windows), lambda a, b: F.xxhash64(a, b))).drop("h")
    hashed = hashed.withColumn("repeats", F.size(F.array_distinct("g")) < F.size("g"))
    placed = F.when(F.col("repeats"), F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).otherwise(F.slice(F.transform("g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))), 1, 0))
    hashed = hashed.withColumn("s", placed).drop("g", "repeats")
    # Neighbours in sorted order with equal windows: both windows repeat.
    twice = F.zip_with("s", F.slice("s", 2, F.greatest(F.size("s") - 1, F.lit(0))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
    covered = F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull())))
    return hashed.withColumn("n_repeat_words", _size(covered)).drop("s")


def verdict(table: tuple[Rule, ...] = TABLE) -> Column:
    """True if every ratio of the table lies within its bounds; a ratio over nothing counts as 0."""
    out = F.lit(True)
    for rule in table:
        above, below = rule.ratio.split(" / ")
        ratio = F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(F.lit(0.0))
        out = out & ratio.between(rule.low, rule.high)
    return out


def judge(docs: DataFrame, text: str = "text", table: tuple[Rule, ...] = TABLE) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every row of docs."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = counts(docs, text).withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(table))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "n_stop_words", "n_upper", "n_lines")
