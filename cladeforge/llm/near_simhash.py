"""Near copies by SimHash of five-word shingles; an exact Jaccard similarity of at least 4/5 follows.

A text's fingerprint has a bit for each of many hashes of its distinct shingles: 1 if over half of the shingles have it. Two
sets at 4/5 differ in some 15 % of the bits. The fingerprint is cut into TABLES keys of WIDTH bits; texts that agree in a key
are a bucket, and those of a bucket whose CARRIED bits differ by no more than BOUND are compared by their sets. At 4/5 a key is
shared with probability 0.037, one of 128 with 0.992; at 0.85 with 0.9998. Small sets have MORE times the tables, as their
bits differ oftener. SimHash can't be sure of a pair, but nothing is left out of a bucket:

1. In each bucket each text is compared with the first one, in one of TURNS orders.
2. All other pairs of a bucket that this hasn't linked, directly or over others, are compared; before it, by WIDE words of bits.
   Texts that meet by chance, of which there are more and more to a bucket, end at the window that finds no close one for them.

Only distinct sets take part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.llm.common import checkpointed, texts, written
from cladeforge.llm.near_copies import _likely, _sets, shingle_sets
from cladeforge.operators.components import components

WIDTH, TABLES = 20, 128
#: Sets of fewer shingles than SMALL have MORE times as many tables.
SMALL, MORE = 32, 4
#: Words of 64 bits that go with each key, and the most bits of them by which sets that are compared differ.
CARRIED, BOUND = 4, 66
#: Words of the keys' bits by which pairs of larger buckets are told, and the most of them by which sets of SMALL and more differ:
#: five standard deviations above what two at 4/5 do.
WIDE, WIDE_BOUND = 40, 470
TURNS = 16
#: Members of a bucket up to which each one looks for a close one among them before any join.
TOLD = 64
_STEP, _A, _B = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def fingerprint(shingles: np.ndarray, words: int) -> np.ndarray:
    """64 * words bits (0 or 1) of a set of 64-bit names."""
    steps = np.arange(1, words + 1, dtype=np.uint64) * _STEP
    ones = np.zeros(64 * words, np.int64)
    for at in range(0, len(shingles), 255):  # sums of 255 bits fit a byte
        x = shingles[at : at + 255, None] + steps
        x = (x ^ (x >> np.uint64(30))) * _A
        x = (x ^ (x >> np.uint64(27))) * _B
        x ^= x >> np.uint64(31)
        ones += np.unpackbits(x.view(np.uint8), axis=1, bitorder="little").view(np.uint64).sum(axis=0).view(np.uint8)
    return (2 * ones > len(shingles)).astype(np.uint8)


def _keys(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and keys of a set."""
    tables = TABLES * (MORE if len(shingles) < SMALL else 1)
    bits = fingerprint(shingles, CARRIED + -(-tables * WIDTH // 64))
    keys = bits[64 * CARRIED : 64 * CARRIED + tables * WIDTH].reshape(tables, WIDTH).astype(np.int32) @ (np.int32(1) << np.arange(WIDTH, dtype=np.int32))
    return np.packbits(bits[: 64 * (CARRIED + WIDE)], bitorder="little").view(np.int64), (np.arange(tables, dtype=np.int32) << WIDTH) | keys


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names, sizes, carried, keys = [], [], [], []
        for s in shingle_sets(batch.column("text")):
            names.append(xxhash.xxh3_128_digest(s.tobytes()))
            sizes.append(len(s))
            own, found = _keys(s)
            carried.append(own)
            keys.append(found)
        at = np.concatenate(([0], np.cumsum([len(x) for x in keys]))).astype(np.int32)
        words = np.concatenate([*carried, np.zeros(0, np.int64)]).reshape(-1, CARRIED + WIDE)
        more = pa.ListArray.from_arrays(pa.array(np.arange(0, WIDE * len(words) + 1, WIDE, dtype=np.int32)), pa.array(words[:, CARRIED:].ravel()))
        lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([*keys, np.zeros(0, np.int32)])))
        columns = [batch.column("rid"), batch.column("doc_id"), pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), *(pa.array(words[:, i]) for i in range(CARRIED)), more, lists]
        yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "name", "size", *_WORDS, "more", "keys"])


_WORDS = [f"f{i}" for i in range(CARRIED)]


def _apart(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y))


def _close(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Sizes allow similarity, and the carried bits differ by BOUND at most."""
    return (5 * a("size") >= 4 * b("size")) & (5 * b("size") >= 4 * a("size")) & (reduce(Column.__add__, (_apart(a(w), b(w)) for w in _WORDS)) <= BOUND)


def _told(a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """Small, or the further bits differ by WIDE_BOUND at most. These are one array: as columns they make code that takes more memory than the rows."""
    apart = F.aggregate(F.zip_with(a("more"), b("more"), _apart), F.lit(0), lambda n, x: n + x)
    return (a("size") < SMALL) | (b("size") < SMALL) | (apart <= WIDE_BOUND)


def _alike(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b of pairs whose sets have a Jaccard similarity of at least 4/5."""
    pairs = checkpointed(pairs)
    met = checkpointed(pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct())
    sets = checkpointed(_likely(rows, met).join(met, "rid", "left_semi").dropDuplicates(["rid"]).select("rid", "text").mapInArrow(_sets, "node long, set array<long>"))
    both = pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    return checkpointed(both.filter(F.expr("9L * size(array_intersect(set_a, set_b)) >= 4L * (size(set_a) + size(set_b))")).select("a", "b"))


def _pairs(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def links(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, root of sets that are linked. rows: rid, text; nodes: node, size, the carried words, keys of distinct sets."""
    own = F.struct("node", "size", *_WORDS)
    keyed = nodes.select(F.explode("keys").alias("key"), "node", "size", *_WORDS)
    in_turn = Window.partitionBy("key").orderBy(F.xxhash64(F.shiftright("key", WIDTH) % TURNS, "node"), "node")
    col = lambda name: (lambda c: F.col(f"{name}.{c}"))
    bucket = Window.partitionBy("key")
    turn = keyed.select("key", own.alias("x"), F.row_number().over(in_turn).alias("n"), F.first(own).over(in_turn).alias("first"))
    turn = turn.withColumn("members", F.count("*").over(bucket)).filter("n > 1")
    # what a bucket has but for its first one: a row without a close one there is done, unless the bucket is too large to tell
    others = F.collect_list(F.when(F.expr(f"members between 3 and {TOLD}"), F.col("x"))).over(bucket)
    partner = (F.col("members") > TOLD) | F.exists("others", lambda y: (y["node"] != F.col("x.node")) & _close(col("x"), y.getField))
    by_first = F.when(_close(col("x"), col("first")), F.col("first.node")).alias("first")
    met = written(turn.withColumn("others", others).select("key", "x", "n", by_first, partner.alias("open")).filter("first is not null or open"))
    edges = _alike(rows, met.filter("first is not null").select(*_pairs("x.node", "first")).distinct())
    roots = components(edges)
    rest = met.filter("open").select("key", "n", "x.*").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = rest.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).filter("least <> most").select("key")
    rest = rest.join(open_, "key").join(nodes.select("node", "more"), "node")
    rest = written(rest.select("key", F.struct("n", "root", "node", "size", *_WORDS, "more").alias("x")))
    x, y = col("x"), col("y")
    further = rest.join(rest.withColumnRenamed("x", "y"), "key").filter((y("n") > x("n")) & (x("root") != y("root")) & _close(x, y) & _told(x, y))
    return components(edges.union(_alike(rows, further.select(*_pairs("x.node", "y.node")).distinct())))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs with one row of those linked directly or through others: that of the least doc_id, and one of several equal rows.

    Null text has no words; texts without words are copies of each other. A null doc_id is kept only where no other is.
    """
    rows = texts(docs)
    named = checkpointed(rows.mapInArrow(_named, f"rid long, doc_id long, name binary, size int, {', '.join(f'{w} long' for w in _WORDS)}, more array<long>, keys array<int>"))
    distinct = checkpointed(named.groupBy("name").agg(F.min("rid").alias("node"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("best")))
    nodes = named.join(distinct.select(F.col("node").alias("rid")), "rid", "left_semi").dropDuplicates(["rid"]).withColumnRenamed("rid", "node")
    roots = links(rows, nodes.filter("size > 0"))
    of_root = distinct.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    kept = of_root.select(F.col("best.rid").alias("rid"))
    rid = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    named_docs = docs.select(F.struct("*").alias("row"), rid.alias("rid"))
    return named_docs.join(kept, "rid", "left_semi").dropDuplicates(["rid"]).select("row.*")
