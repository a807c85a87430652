"""Mixing sources by temperature, realised as budgeted block permutations.

Source weights are the source token shares raised to an exponent and normalised. The
exponent in [0, 1] is bisected: the largest whose weights reach a target entropy (given as
a share of the largest possible), or the smallest whose most repeated source stays within
a repetition limit; where both are given the repetition limit prevails. Each source then
gets ``weight * budget`` tokens. Its texts are dealt to blocks by a hash of key and text (rows
without a key, or with one in common, spread like any others); every pass (epoch)
over the source visits the blocks in an order of its own and the texts of a block in an
order of their own; passes follow each other until the source's budget is used (the text
that crosses it is the last one). Everything is DataFrame expressions.

Only block totals are summed in order across a source (one row per ~``BLOCK`` texts), and
these in up to 4096 ranges of their place in the order, so a source with a third of all rows
is sorted in many tasks. The bisection holds one number per source.

Texts with the same key, source and text are one unit that is chosen as a whole. Defined
results: a null source is a source of its own; a null or empty text has no token and
travels with its block; a source without any token gets weight 0 and no row; an empty table
gives no rows; further columns are carried by :func:`mix` and ignored by :func:`plan`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import join_small
from .common import materialize, text_of

BLOCK = 1024                        # texts of a block, about
STEPS = 40                          # halvings of the exponent's range
DIGITS = 6                          # of the exponent
RANGE = 3                           # hex digits of a block's draw: blocks are ordered in 16 ** RANGE ranges


def n_words(text: str) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, counted without an array of them."""
    marks = F.regexp_replace(text_of(text), r"[^\x20\x09-\x0D]+", "w")
    return F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")).cast("long")


def content_of(text: str) -> Column:
    """60 bits of the text's MD5: what tells texts of one key apart, in any engine."""
    return F.conv(F.substring(F.md5(text_of(text)), 1, 15), 16, 10).cast("long")


def _units(docs: DataFrame, key: str, source: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        content_of(text).alias("content"), n_words(text).alias("tokens"),
    ).groupBy("key", "source", "content").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))


def _sum(logs: Column, f) -> Column:
    return F.aggregate(logs, F.lit(0.0), lambda acc, x: acc + f(x))


def exponent(logs: Column, ratio: Column, target_entropy: float | None, max_repeat: float | None) -> Column:
    """The exponent for an array of log shares; ``ratio``: budget over all tokens."""
    def entropy(a):
        z = _sum(logs, lambda x: F.exp(a * x))
        return F.log(z) - a * _sum(logs, lambda x: x * F.exp(a * x)) / z

    def repeat(a):
        return ratio * F.exp((a - 1) * F.array_min(logs)) / _sum(logs, lambda x: F.exp(a * x))

    def bisect(low_side):
        start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

        def halve(acc, _):
            mid = (acc["lo"] + acc["hi"]) / 2
            low = low_side(mid)                          # the solution lies above mid
            return F.struct(F.when(low, mid).otherwise(acc["lo"]).alias("lo"),
                            F.when(low, acc["hi"]).otherwise(mid).alias("hi"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, halve)

    found = F.lit(0.0) if target_entropy is None else F.when(
        entropy(F.lit(1.0)) >= target_entropy * F.log(F.size(logs).cast("double")), F.lit(1.0)).otherwise(
        bisect(lambda a: entropy(a) >= target_entropy * F.log(F.size(logs).cast("double")))["lo"])
    if max_repeat is not None:
        least = F.when(repeat(F.lit(0.0)) <= max_repeat, F.lit(0.0)).otherwise(
            bisect(lambda a: repeat(a) > max_repeat)["hi"])
        found = F.greatest(found, least)
    return F.round(found, DIGITS)


def weights(units: DataFrame, target_entropy: float | None, max_repeat: float | None,
            budget: int | None) -> DataFrame:
    """(source, docs, total, alpha, weight, quota) of every source with a token."""
    by_source = units.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("tokens").alias("total")) \
        .where("total > 0")
    whole = by_source.agg(F.sum("total").alias("whole"), F.sort_array(F.collect_list("total")).alias("totals"))
    given = F.col("whole") if budget is None else F.lit(budget).cast("long")
    logs = F.transform("totals", lambda t: F.log(t / F.col("whole")))
    whole = whole.select("whole", given.alias("budget"), logs.alias("logs"))
    whole = whole.select("whole", "budget", "logs", exponent(
        F.col("logs"), F.col("budget") / F.col("whole"), target_entropy, max_repeat).alias("alpha"))
    whole = whole.select("whole", "budget", "alpha", _sum(F.col("logs"), lambda x: F.exp(F.col("alpha") * x)).alias("z"))
    one = F.broadcast(whole)                             # a single row
    w = F.exp(F.col("alpha") * F.log(F.col("total") / F.col("whole"))) / F.col("z")
    return by_source.join(one).select("source", "docs", "total", "alpha", w.alias("weight"),
                                      F.floor(F.round(w * F.col("budget"), 3)).cast("long").alias("quota"))


def plan(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text",
         target_entropy: float | None = 0.95, max_repeat: float | None = 4.0, budget: int | None = None,
         seed: int = 7) -> DataFrame:
    """One row per chosen unit and epoch: key, source, content, rows, epoch, n_tokens, stream_at (tokens of the
    source dealt before it), place (0..1: sort by it to interleave the sources), weight, alpha."""
    units = materialize(_units(docs, key, source, text), "units")
    w = materialize(weights(units, target_entropy, max_repeat, budget), "weights")
    # null-safe: the source as a text that is never null
    name = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))
    rows = join_small(units.withColumn("_s", name), w.withColumn("_s", name).drop("source"), "_s", "inner")
    mark = F.concat_ws("|", F.coalesce(F.col("key").cast("string"), F.lit("")), F.col("content").cast("string"))

    def draw(*parts):
        return F.md5(F.concat_ws("|", F.lit(str(seed)), *parts))

    blocks = F.ceil(F.col("docs") / F.lit(BLOCK)).cast("long")
    epochs = F.ceil(F.col("quota") / F.col("total")).cast("int")
    rows = rows.where("quota > 0").select(
        "*", F.pmod(F.conv(F.substring(draw(mark), 1, 8), 16, 10).cast("long"), blocks).alias("block"),
        F.explode(F.sequence(F.lit(0), epochs - 1)).alias("epoch"))
    epoch = F.col("epoch").cast("string")
    up_to = W.unboundedPreceding
    # blocks are visited in the order of their draws: ranges of draws first, then the blocks of a range
    totals = rows.groupBy("_s", "epoch", "block").agg(F.sum("tokens").alias("size")) \
        .withColumn("visit", draw(epoch, F.col("_s"), F.col("block").cast("string"))) \
        .withColumn("range", F.substring("visit", 1, RANGE))
    by_range = W.partitionBy("_s", "epoch").orderBy("range").rowsBetween(up_to, -1)
    ranges = totals.groupBy("_s", "epoch", "range").agg(F.sum("size").alias("size")) \
        .withColumn("before", F.coalesce(F.sum("size").over(by_range), F.lit(0))).drop("size")
    by_block = W.partitionBy("_s", "epoch", "range").orderBy("visit", "block").rowsBetween(up_to, -1)
    offsets = totals.withColumn("among", F.coalesce(F.sum("size").over(by_block), F.lit(0))) \
        .join(ranges, ["_s", "epoch", "range"]).select("_s", "epoch", "block", (F.col("before") + F.col("among")).alias("ahead"))
    in_block = W.partitionBy("_s", "epoch", "block").orderBy("drawn", "key", "content").rowsBetween(up_to, -1)
    rows = rows.withColumn("drawn", draw(epoch, mark)) \
        .withColumn("inside", F.coalesce(F.sum("tokens").over(in_block), F.lit(0)))
    rows = rows.join(offsets, ["_s", "epoch", "block"])
    at = F.col("epoch") * F.col("total") + F.col("ahead") + F.col("inside")
    return rows.withColumn("stream_at", at).where("stream_at < quota").select(
        F.col("key").alias(key), F.col("source").alias(source), "content", "rows", "epoch",
        F.col("tokens").alias("n_tokens"), "stream_at",
        ((F.col("stream_at") + 0.5) / F.col("quota")).alias("place"), "weight", "alpha")


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` as often as the plan takes them."""
    def name(c):
        return F.coalesce(F.concat(F.lit("s"), F.col(c).cast("string")), F.lit(""))

    chosen = plan(docs, key, source, text, **how).select(F.col(key).alias("k"), name(source).alias("s"),
                                                         F.col("content").alias("c"))
    rows = docs.select(F.col(key).alias("k"), name(source).alias("s"),
                       content_of(text).alias("c"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = rows["k"].eqNullSafe(chosen["k"]) & (rows["s"] == chosen["s"]) & (rows["c"] == chosen["c"])
    return rows.join(chosen, same).select("row.*")
