"""SimHash near-duplicates found with pivot distance tables.

A text's 64-bit fingerprint is the bitwise majority over the XXH64 values of its word
shingles. Two fingerprints link when they differ in at most ``max_bits`` bits. Distances to
fixed reference fingerprints (pivots) are computed for the fingerprints of a cell when it is
searched; by the triangle inequality a pair whose distances to any pivot differ by more than ``max_bits`` cannot
link, so the maximum coordinate difference discards pairs and only survivors are verified
by their differing bits. The rows meet in blocks: cut into ``b`` bit blocks, a linked pair
agrees on ``b - max_bits`` of them at least (pigeonhole), so every such choice of blocks is
one equality key and no link is lost; inside a key the rows are sorted by the first pivot
distance and a sweep ends where that coordinate alone rules further pairs out.

Equal fingerprints are one node, whatever their number of texts. A key with over ``CELL``
nodes is split into pieces whose pairs of pieces are cells of their own. Each cell passes on
a spanning forest of its links, never the pairs; components are joined by alternating
large-star / small-star rounds written to the shared folder.

Defined results: a null or empty text (no word) has fingerprint zero and links like any
other; fewer words than a shingle make one shingle of all words; a row with a null key gets
its fingerprint, links nothing and has a null component; repeated rows share a component; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ..operators.joins import join_small
from . import text as T
from .common import materialize, with_key

SHINGLE = 3
MAX_BITS = 3
SEED = 42
CELL = 4096                         # nodes of a key handled together
BUCKET = 32768                      # rows of a task's group, about
CHUNK = 2 << 20
#: reference fingerprints: fixed pseudo-random words
PIVOTS = T.mix(np.arange(1, 25, dtype=np.uint64))


def _shingles(column: pa.Array, words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as single-space-joined lower-case words; byte ranges of their shingles, and
    where each text's shingles begin."""
    w = T.word_column(column)
    size = w.end - w.start
    at = np.cumsum(size + 1) - (size + 1)                # every word with one space after it
    joined = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    body = np.ones(len(joined), bool)
    body[at + size] = False
    joined[body] = w.data[~T.SPACE[w.data]]
    n = w.counts
    have = np.where(n >= words, n - words + 1, np.minimum(n, 1))
    bounds = np.append(0, np.cumsum(have))
    first = np.repeat(w.bounds[:-1], have) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], have)
    last = first + np.repeat(np.minimum(n, words), have) - 1
    return joined.tobytes(), at[first], at[last] + size[last], bounds


def fingerprint(column: pa.Array, words: int = SHINGLE) -> np.ndarray:
    """64-bit fingerprints (unsigned) of a string column."""
    joined, start, end, bounds = _shingles(column, words)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(start.tolist(), end.tolist())), np.uint64, len(start))
    out = np.zeros(len(bounds) - 1, np.uint64)
    some = np.flatnonzero(np.diff(bounds))
    if not len(some):
        return out
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, bounds[some], axis=0, dtype=np.int32)
    major = (2 * ones > np.diff(bounds)[some, None]).astype(np.uint8)
    out[some] = np.packbits(major, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE) -> DataFrame:
    """(key, fp) of every row; fp holds the 64 bits as a signed long."""
    def apply(batches):
        for c in T.chunks(batches, limit=CHUNK):
            fp = fingerprint(c.column("text"), words).view(np.int64)
            yield pa.record_batch([c.column("key"), pa.array(fp)], ["key", "fp"])

    rows = with_key(docs, key, text).withColumn("key", F.col("key").cast("long"))
    return rows.mapInArrow(apply, "key long, fp long").withColumnRenamed("key", key)


def blocks_for(nodes: int, max_bits: int) -> list[int]:
    """Masks of the block choices: few for few nodes, more selective ones for more, so that
    about 16 nodes share a key. Every choice of masks finds every link."""
    for b in range(max_bits + 1, max_bits + 5):
        if nodes <= 16 * 2.0 ** (64 * (b - max_bits) / b):
            break
    edge = [round(64 * i / b) for i in range(b + 1)]
    block = [((1 << (edge[i + 1] - edge[i])) - 1) << edge[i] for i in range(b)]
    return [sum(block[i] for i in kept) for kept in combinations(range(b), b - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a[i] and b[i] in ``parent`` (smaller index is the root)."""
    while len(a):
        x, y = parent[a], parent[b]
        differ = x != y
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent[:] = up


def forest(group: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups, as a spanning forest: positions (node, root)."""
    pivots = np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)      # the distance table
    order = np.lexsort((pivots[:, 0], group))
    group, fp, pivots = group[order], fp[order], pivots[order]
    parent = np.arange(len(fp))
    left, step = np.arange(len(fp)), 0
    while len(left):
        step += 1
        left = left[left + step < len(fp)]
        right = left + step
        near = (group[left] == group[right]) & (pivots[right, 0] - pivots[left, 0] <= max_bits)
        left = left[near]                                # sorted: what is too far now stays too far
        a = left[parent[left] != parent[left + step]]
        for j in range(1, pivots.shape[1]):              # maximum coordinate difference
            a = a[np.abs(pivots[a, j] - pivots[a + step, j]) <= max_bits]
        a = a[np.bitwise_count(fp[a] ^ fp[a + step]) <= max_bits]
        _merge(parent, a, a + step)
    linked = np.flatnonzero(parent != np.arange(len(fp)))
    return order[linked], order[parent[linked]]


def links(nodes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (u, v) between nodes (fp, rep): a spanning forest of each cell."""
    count = nodes.count()
    masks = blocks_for(count, max_bits)
    rows = nodes.select("fp", "rep", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks]))
                        .alias("choice", "value"))
    heavy = (rows.groupBy("choice", "value").count().where(F.col("count") > CELL)
             .select("choice", "value", F.ceil(F.col("count") / CELL).cast("int").alias("pieces")))
    rows = join_small(rows, heavy, ["choice", "value"], "left")
    piece = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    other = F.explode(F.when(F.col("pieces").isNull(), F.array(F.lit(0)))
                      .otherwise(F.sequence(F.lit(0), F.col("pieces") - 1)))
    rows = rows.withColumn("piece", F.coalesce(piece, F.lit(0))).withColumn("other", other)
    group = F.xxhash64("choice", "value", F.least("piece", "other"), F.greatest("piece", "other"))
    buckets = max(1, -(-count * len(masks) // BUCKET))
    rows = rows.select("fp", "rep", group.alias("cell"), F.pmod(F.xxhash64(group), F.lit(buckets)).alias("bucket"))

    def apply(table: pa.Table) -> pa.Table:
        rep = table["rep"].to_numpy()
        node, root = forest(table["cell"].to_numpy(), table["fp"].to_numpy().view(np.uint64), max_bits)
        return pa.table({"u": rep[node], "v": rep[root]})

    return rows.groupBy("bucket").applyInArrow(apply, "u long, v long").where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (u, v): component is the smallest node
    reachable. Alternating large-star and small-star (Kiveris et al., 2014)."""
    def larger_first(df):
        return df.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    def star(df, least):
        return df.join(least, "u")

    edges, before = materialize(larger_first(edges), "links"), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = tuple(state)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = larger_first(star(both, least).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = star(large, least)
        edges = materialize(larger_first(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(key, fp, component_id) of every row."""
    fps = materialize(fingerprints(docs, key, text, words), "fingerprints")
    nodes = materialize(fps.where(F.col(key).isNotNull()).groupBy("fp").agg(F.min(key).alias("rep")), "nodes")
    found = components(links(nodes, max_bits))
    # a node without links is its own component
    where = nodes.join(found.withColumnRenamed("node", "rep"), "rep", "left") \
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    out = fps.join(where, "fp", "left")
    return out.select(key, "fp", F.when(F.col(key).isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component: the one with the smallest key (of equal keys, the smallest
    text, then the smallest hash of the other plain columns). Rows with a null key stay."""
    found = near_duplicates(docs, key, text, words, max_bits).where(F.col(key) == F.col("component_id")) \
        .select(F.col(key).alias("id")).distinct()
    plain = [F.col(f"`{f.name}`") for f in docs.schema if isinstance(f.dataType, AtomicType)]
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("by"), F.xxhash64(*plain).alias("then"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    order = W.partitionBy("id").orderBy(F.col("by").asc_nulls_first(), "then")
    one = rows.join(found, "id", "left_semi").withColumn("n", F.row_number().over(order)).where("n = 1")
    return one.select("row").unionByName(rows.where("id is null").select("row")).select("row.*")
