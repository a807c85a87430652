"""Quality rules with a distribution-divergence verdict, in DataFrame expressions only.

Plain counts (words, symbols, repeated lines, repeated 8-word windows) give the base rules.
The verdict compares each text with references of its language, learned from all texts of
that language: the histogram over character classes, and the histogram over the language's
most common words plus one bin for all other words, by Jensen-Shannon distance (square root
of the base-2 divergence, 0 to 1). A text is kept if both distances are small enough; a
histogram of too few characters or words is not judged (minimum-length guards).

Common words are chosen by exact counts over every word: equal words are added up inside tasks
first, and each task passes on a language's best words only, whatever the language's share.
Only per-text figures are written between the passes, never texts. Windows are compared as
chained 64-bit hashes inside one row.

Defined results: a null or empty text has no word, fails the base rules and is not kept; a
null language is a language of its own; an empty table gives no rows; repeated rows are
each judged; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_small
from .common import materialize, text_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
COMMON = 32                 # common words of a language
MIN_WORDS, MIN_CHARS = 60, 300
MAX_WORD_DISTANCE, MAX_CHAR_DISTANCE = 0.45, 0.25
#: character classes: what is left of a text when all other characters are taken out
CLASSES = {"lower": r"[^a-z]+", "upper": r"[^A-Z]+", "digit": r"[^0-9]+", "space": r"[^\x20\x09-\x0D]+",
           "symbol": r"[^#*$%&|<>]+", "other": r"[\x00-\x7F]+"}


def _words(t: Column) -> Column:
    return F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), "")


def counts(docs: DataFrame) -> DataFrame:
    """``docs`` (key, lang, text) with words and the plain counts; keeps ``words``, ``text`` and
    ``tight``, the text without white space, in which the other character classes are counted."""
    df = docs.withColumn("words", _words(F.col("text"))).withColumn("tight", F.regexp_replace("text", r"[\x20\x09-\x0D]+", ""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    # every column that a lambda looks into is used twice or more in the next projection: the
    # optimizer then keeps it as a column and does not compute it anew for each element
    df = df.withColumn("lines", lines).withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df, last, span = df.withColumn("chain", F.col("hashes")), F.size("hashes") - (WINDOW - 1), 1
    while span < WINDOW:                                   # two neighbouring spans make one of twice the words; those beyond the end are cut off
        df = df.withColumn("chain", F.zip_with("chain", F.slice("chain", span + 1, F.size("chain")), lambda a, b: F.xxhash64(a, b)))
        span *= 2
    df = df.withColumn("windows", F.when(last > 0, F.slice("chain", F.lit(1), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<bigint>")))
    # windows with an equal: sorted with their places, next to one another
    again = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("ranked", F.when(again, F.sort_array(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twin = F.filter("ranked", lambda x, j: (F.get("ranked", j - 1)["h"] == x["h"]) | (F.get("ranked", j + 1)["h"] == x["h"]))
    df = df.withColumn("places", F.sort_array(F.transform(twin, lambda x: x["i"])))
    # a place covers its window, as far as the next place does not
    covered = F.aggregate(
        F.transform("places", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get("places", j + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return df.select(
        "key", "lang", "text", "words", "tight",
        F.size("words").cast("long").alias("n_words"),
        F.length("tight").cast("long").alias("word_chars"),
        F.length(F.regexp_replace("tight", CLASSES["symbol"], "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def common_words(docs: DataFrame) -> DataFrame:
    """(lang, common): each language's most common lower-case words (equal counts: the smaller word first), in
    a fixed order. All words are counted; a task passes on its best words of a language only."""
    word = docs.select("lang", F.explode(_words(F.lower("text"))).alias("word")).groupBy("lang", "word").count()
    first = Window.partitionBy("lang").orderBy(F.col("count").desc(), "word")
    top = word.withColumn("n", F.row_number().over(first)).where(F.col("n") <= COMMON)
    found = top.groupBy("lang").agg(F.sort_array(F.collect_list("word")).alias("common"))
    every = docs.select("lang").distinct().join(found, "lang", "left").select("lang", F.coalesce("common", F.array()).alias("common"))
    # the same by length: the words of each, and their places in ``common``
    lengths = F.sequence(F.lit(1), F.greatest(F.coalesce(F.array_max(F.transform("common", F.length)), F.lit(1)), F.lit(1)))
    places = F.transform(lengths, lambda n: F.transform(F.filter("common", lambda w: F.length(w) == n), lambda w: F.array_position("common", w).cast("int")))
    return every.withColumn("sized", F.transform(lengths, lambda n: F.filter("common", lambda w: F.length(w) == n))).withColumn("places", places)


def histograms(df: DataFrame) -> DataFrame:
    """Adds ``chars`` (by class, then the rest of ASCII) and ``hits`` (by common word, then
    all other words)."""
    # a word is looked for among the common words of its length
    df = df.withColumn("low", F.transform("words", lambda w: F.lower(w)))
    at = lambda w: F.array_position(F.get("sized", F.length(w) - 1), w)
    df = df.withColumn("found", F.filter(F.transform("low", lambda w: F.when(
        at(w) > 0, F.get(F.get("places", F.length(w) - 1), (at(w) - 1).cast("int"))).otherwise(F.lit(0))), lambda x: x > 0))
    # in order, each bin's place once more: bins begin where their number first stands
    df = df.withColumn("ranked", F.sort_array(F.concat("found", F.sequence(F.lit(1), F.lit(COMMON + 1)))))
    df = df.withColumn("starts", F.array(*[F.array_position("ranked", F.lit(k)).cast("int") for k in range(1, COMMON + 2)]))
    bins = F.transform(F.sequence(F.lit(1), F.size("common")), lambda k: F.get("starts", k) - F.get("starts", k - 1) - 1)
    bins = F.when(F.size("common") > 0, bins).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("hits", F.concat(bins, F.array(F.size("words") - F.size("found"))))
    known = {"space": F.length("text") - F.col("word_chars").cast("int"), "symbol": F.col("n_symbols").cast("int")}
    sizes = [known[c] if c in known else F.length(F.regexp_replace("tight", p, "")) for c, p in CLASSES.items()]
    df = df.withColumn("classes", F.array(*sizes))
    total = F.aggregate("classes", F.lit(0), lambda a, x: a + x)
    return df.withColumn("chars", F.concat("classes", F.array(F.length("text") - total)))


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts and one of shares; null if empty."""
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x)

    def part(p, q):
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)

    parts = F.zip_with(counts, reference, lambda n, q: part(n / total, q))
    return F.when(total > 0, F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0))))


def _shares(column: str, bins: int) -> Column:
    """The summed histogram of a group."""
    return F.array(*[F.coalesce(F.sum(F.get(column, F.lit(i))), F.lit(0)) for i in range(bins)])


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per row of ``docs``: key, the counts, base_failed, word_distance, char_distance, kept."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
                       text_of(text).alias("text"))
    common = materialize(common_words(rows), "common-words")
    judged = histograms(join_small(counts(rows), common, "lang"))
    per_text = materialize(judged.select(
        "key", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "hits", "chars"), "quality")
    sums = per_text.groupBy("lang").agg(_shares("hits", COMMON + 1).alias("h"), _shares("chars", len(CLASSES) + 1).alias("c"))

    def normal(c):
        total = F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
        return F.transform(c, lambda x: F.when(total > 0, x / total).otherwise(0.0))

    # fewer common words than COMMON leave the last bins empty: cut to the texts' histograms
    reference = sums.select("lang", normal(F.col("h")).alias("h"), normal(F.col("c")).alias("c"))
    df = join_small(per_text, reference, "lang")
    df = df.withColumn("word_distance", distance(F.col("hits"), F.slice("h", 1, F.size("hits")))) \
        .withColumn("char_distance", distance(F.col("chars"), F.col("c")))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    fits = ((F.col("n_words") < MIN_WORDS) | (F.col("word_distance") <= MAX_WORD_DISTANCE)) & \
        ((F.aggregate("chars", F.lit(0), lambda a, x: a + x) < MIN_CHARS) | (F.col("char_distance") <= MAX_CHAR_DISTANCE))
    return df.select(F.col("key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                     failed.alias("base_failed"), "word_distance", "char_distance",
                     (~failed & F.coalesce(fits, F.lit(False))).alias("kept"))
