"""Quality rules: a threshold table compiled into one projection of built-in expressions.

Everything is a Catalyst expression over the row's own text: no user function, no shuffle, one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, let

#: Function words of the corpus's languages (fixed values).
STOP_WORDS = tuple(
    """the of and to in is that for it as was with be by on not he his but at are this have from or an they which you
    le la les de des du et en un une que qui dans pour par sur est au aux avec ne se pas plus
    der die das und den von zu mit sich des auf ist im dem nicht ein eine als auch es an er so
    el los las del y en un una que por con no se su para al lo como más""".split()
)


@dataclass(frozen=True)
class Threshold:
    """A document passes if ``low <= metric <= high``; None leaves a side open. A null metric passes."""

    rule: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The table the query uses. Ratios are of words, characters or lines of the whole text.
THRESHOLDS = (
    Threshold("length", "n_words", 50, None),
    Threshold("word_length", "mean_word_chars", 2.0, 12.0),
    Threshold("symbols", "symbol_ratio", None, 0.10),
    Threshold("shouting", "upper_ratio", None, 0.40),
    Threshold("stop_words", "stop_ratio", 0.03, None),
    Threshold("repeated_lines", "dup_line_ratio", None, 0.40),
    Threshold("repeated_words", "repeat_ratio", None, 0.50),
)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def repeated_words(words: Column, size: int = 3) -> Column:
    """How many words lie in a ``size``-word window that the text has twice or more.

    Window hashes are sorted with their starts; a window is repeated if a neighbour has its hash and its words. Each
    start then adds the words up to the next start, ``size`` at most. n log n in the words of one text.
    """

    def same(a: Column, b: Column) -> Column:
        met = None
        for k in range(size):
            test = F.get(words, a["at"] + k) == F.get(words, b["at"] + k)
            met = test if met is None else met & test
        return (a["hash"] == b["hash"]) & met

    def starts(ordered: Column) -> Column:
        twice = F.filter(ordered, lambda x, k: F.coalesce(same(x, F.get(ordered, k - 1)), F.lit(False)) | F.coalesce(same(x, F.get(ordered, k + 1)), F.lit(False)))
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(found: Column) -> Column:
        steps = F.transform(found, lambda x, k: F.least(F.lit(size), x - F.coalesce(F.get(found, k - 1), x - size)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(words) - size), lambda i: F.struct(F.xxhash64(*[F.get(words, i + k) for k in range(size)]).alias("hash"), i.alias("at"))
    )
    return F.when(F.size(words) > size, let(F.sort_array(windows), lambda ordered: let(starts(ordered), covered))).otherwise(F.lit(0).cast("long"))


def metrics(text: Column) -> Column:
    """A struct of all metrics of one text; null counts as empty."""
    plain = F.coalesce(text, F.lit(""))
    long = lambda c: c.cast("long")

    def of(words: Column) -> Column:
        return F.struct(
            long(F.size(words)).alias("n_words"),
            repeated_words(words).alias("n_repeat_words"),
            long(F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))).alias("n_stop"),
        )

    lines = F.filter(F.split(plain, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    gone = lambda chars: F.length(plain) - F.length(F.translate(plain, chars, ""))
    return F.struct(
        let(words_of(plain), of).alias("by_word"),
        let(lines, lambda x: F.struct(long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("by_line"),
        long(F.length(F.translate(plain, " \t\n\x0b\f\r", ""))).alias("word_chars"),
        long(gone("#*$%&|<>")).alias("n_symbols"),
        long(F.length(plain) - F.length(F.regexp_replace(plain, r"\p{Lu}", ""))).alias("n_upper"),
    )


def quality_rules(docs: DataFrame, thresholds: tuple[Threshold, ...] = THRESHOLDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per document the metrics, ``base_failed``, ``kept`` and ``failed_rules``.

    Null and empty texts have no words and fail the base rule. Repeated rows give repeated results; an empty table
    gives none. Columns other than id and text are not read.
    """
    m = docs.select(F.col(id_column).alias("doc_id"), metrics(F.col(text_column)).alias("m"))
    flat = m.select("doc_id", "m.by_word.*", "m.by_line.*", "m.word_chars", "m.n_symbols", "m.n_upper")
    per = lambda a, b: F.try_divide(F.col(a), F.col(b))
    rated = flat.select(
        "*",
        per("word_chars", "n_words").alias("mean_word_chars"),
        per("n_symbols", "n_words").alias("symbol_ratio"),
        per("n_upper", "word_chars").alias("upper_ratio"),
        per("n_stop", "n_words").alias("stop_ratio"),
        per("n_dup_lines", "n_lines").alias("dup_line_ratio"),
        per("n_repeat_words", "n_words").alias("repeat_ratio"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )

    def failed(t: Threshold) -> Column:
        low = F.lit(False) if t.low is None else F.col(t.metric) < t.low
        high = F.lit(False) if t.high is None else F.col(t.metric) > t.high
        return F.when(F.coalesce(low | high, F.lit(False)), F.lit(t.rule))

    rules = F.filter(F.array(*[failed(t) for t in thresholds]), lambda x: x.isNotNull())
    return rated.select("*", rules.alias("failed_rules")).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
