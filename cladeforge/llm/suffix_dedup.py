"""Exact removal of repeated byte strings over the whole corpus, by sorting the suffixes that can repeat.

1. Every LENGTH-byte string of a text is named by its minimizer: the GRAM-byte string in it with the least hash. A run of
   neighbouring strings with one minimizer is one row (an anchor), about one row for 69 bytes. Equal strings have equal
   minimizers at equal places, so they meet under one anchor hash.
2. Anchors whose hash is found once can't repeat and go. Where all rows of an anchor hash have the same surroundings
   (inside copies), all their strings repeat.
3. Elsewhere (where repeats begin and end), the distinct surroundings of an anchor are brought together and sorted by
   deep-shallow suffix sorting: to the right of the anchor's place, and backwards to its left. Neighbours' common prefixes
   tell which of the strings over the anchor are found in more than one row.
4. An anchor with too many distinct surroundings for one task is split: its strings by half of their places over the anchor,
   then by the bytes that all strings of a half have around it, and again until no group is too large. A group at one place
   is one string, so this ends. All groups are sorted.

Equal surroundings are told by the anchor's and their own 64-bit hash together. Both sides of the join that brings anchors' rows together
are read from shuffles, so a hot anchor's rows are dealt to several tasks (adaptive skew join).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.common import as_bytes, checkpointed, flat_bytes, texts, written
from cladeforge.llm.suffix_sort import common, deep_shallow

LENGTH, GRAM = 200, 64
WINDOW = LENGTH - GRAM + 1
#: Starts looked at together; bounds the memory of a task whatever the length of a text.
CHUNK = 1 << 18
#: Distinct surroundings of an anchor hash that are sorted in one task.
TOGETHER = 1_000
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = CHUNK + LENGTH + 1
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, x, np.uint64)))) for x in (_BASE, inverse))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def anchors(data: np.ndarray, begins: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For texts on end: arrays of anchor hash, hash of the surroundings, text number, first start in it, and geometry.

    Geometry is the anchor's place after the first start, times 256, plus the number of further starts.
    """
    up, down = _powers()
    lengths = np.diff(begins)
    usable = np.flatnonzero(lengths >= LENGTH)
    for c0 in range(0, len(data), CHUNK):
        c1 = min(c0 + CHUNK, len(data) - LENGTH + 1)
        if c1 <= c0:
            break
        here = usable[np.searchsorted(begins[1:][usable], c0, "right") : np.searchsorted(begins[:-1][usable], c1, "left")]
        if not len(here):
            continue
        steps = np.zeros(c1 - c0 + 1, np.int32)
        np.add.at(steps, np.clip(begins[here] - c0, 0, c1 - c0), 1)
        np.add.at(steps, np.clip(begins[here + 1] - LENGTH + 1 - c0, 0, c1 - c0), -1)
        valid = np.cumsum(steps[:-1]) > 0
        part = data[c0 : c1 + LENGTH - 1]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: n - GRAM + 1])
        best = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        size, starts = 1, c1 - c0
        while 2 * size <= WINDOW:
            best = np.minimum(best[:-size], best[size:])
            size *= 2
        best = np.minimum(best[:starts], best[WINDOW - size :][:starts])
        place = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
        change = np.empty(starts + 1, bool)
        change[0] = change[-1] = True
        change[1:-1] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
        edges = np.flatnonzero(change)
        lo, hi = edges[:-1], edges[1:] - 1
        lo, hi = lo[valid[lo]], hi[valid[lo]]
        at, further = place[lo] - lo, hi - lo
        geo = at * 256 + further
        around = _mixed((sums[hi + LENGTH] - sums[lo]) * down[lo] + geo.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
        text = np.searchsorted(begins, lo + c0, "right") - 1
        yield grams[place[lo]].view(np.int64), around.view(np.int64), text, lo + c0 - begins[text], geo


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rid = batch.column("rid").to_numpy(zero_copy_only=False)
        for anchor, ctx, text, lo, geo in anchors(*flat_bytes(batch.column("text"))):
            yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(ctx), pa.array(rid[text]), pa.array(lo.astype(np.int64)), pa.array(geo.astype(np.int32))], ["anchor", "ctx", "rid", "lo", "geo"])


def _surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, asked in zip(as_bytes(batch.column("text")), batch.column("asked").to_pylist(), strict=True):
            rows += [(x["key"], x["ctx"], x["geo"], x["copies"], text[x["lo"] : x["lo"] + x["geo"] % 256 + LENGTH]) for x in asked]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * 5, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["key", "ctx", "geo", "copies", "piece"])


def _halved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Surroundings cut in two: the strings at places least to most over the anchor, in halves; each half is named by the bytes that all its strings have."""
    names = [x.split()[0] for x in _HALVES.split(", ")]
    types = (*[pa.int64()] * 4, pa.int32(), pa.int64(), pa.binary(), *[pa.int32()] * 3)
    for batch in batches:
        rows = []
        for key, ctx, geo, copies, piece, least, most in zip(*(batch.column(k).to_pylist() for k in ("key", "ctx", "geo", "copies", "piece", "least", "most")), strict=True):
            at, further, middle = geo // 256, geo % 256, (least + most) // 2
            for a, b in ((least, middle), (middle + 1, most)):
                low, high = max(a, at - further), min(b, at)
                if low <= high:
                    part, new = piece[at - high : at - low + LENGTH], high * 256 + high - low
                    name = xxhash.xxh3_64_intdigest(piece[at - a : at - b + LENGTH], key * 512 + a & (1 << 64) - 1) - (1 << 63)
                    rows.append((key, ctx, name, xxhash.xxh3_64_intdigest(part, new) - (1 << 63), new, copies, part, a, b, at - high))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True) if rows else [[]] * len(types), types, strict=True)], names)


_HALVES = "up_key long, up_ctx long, key long, ctx long, geo int, copies long, piece binary, least int, most int, shift int"


def _merged(spans: list[tuple[int, int]], gap: int = 0) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1] + gap:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


def repeats(pieces: list[bytes], geos: list[int], copies: list[int]) -> list[list[tuple[int, int]]]:
    """For each piece, the runs (first, last) of starts in it whose LENGTH bytes are found in another row of the anchor."""
    n = len(pieces)
    at, further = [g // 256 for g in geos], [g % 256 for g in geos]
    sides = []
    for strings in ([p[a:] for p, a in zip(pieces, at, strict=True)], [p[:a][::-1] for p, a in zip(pieces, at, strict=True)]):
        order = deep_shallow(strings)
        sides.append((order, [0, *(common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False))]))
    # a start's distance before the anchor, o, is from at - further to at; bytes from the anchor on: LENGTH - o
    if n <= 12:
        shared = []
        for order, prefix in sides:
            table = {}
            for x in range(n):
                low = LENGTH * 2
                for y in range(x + 1, n):
                    low = min(low, prefix[y])
                    table[order[x], order[y]] = table[order[y], order[x]] = low
            shared.append(table)
        out = []
        for i in range(n):
            runs = [(0, further[i])] if copies[i] > 1 else []
            for j in range(n):
                if i != j:
                    least = max(LENGTH - shared[0][i, j], at[i] - further[i], at[j] - further[j])
                    most = min(shared[1][i, j], at[i], at[j])
                    if least <= most:
                        runs.append((at[i] - most, at[i] - least))
            out.append(_merged(runs, 1))
        return out
    a, f, many = np.array(at), np.array(further), np.array(copies)
    hits = np.zeros((n, WINDOW), bool)
    for o in range(WINDOW):
        own = np.flatnonzero((o >= a - f) & (o <= a))
        if len(own):
            classes = []
            for (order, prefix), need in zip(sides, (LENGTH - o, o), strict=True):
                number = np.empty(n, np.int64)
                number[order] = np.cumsum(np.array(prefix) < need)
                classes.append(number[own])
            _, back, count = np.unique(classes[0] * (n + 1) + classes[1], return_inverse=True, return_counts=True)
            hits[own, o] = (count[back] > 1) | (many[own] > 1)
    return [_merged([(int(a[i]) - int(o), int(a[i]) - int(o)) for o in np.flatnonzero(hits[i])], 1) for i in range(n)]


def _resolved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in ("key", "ctx", "geo", "copies", "piece")), strict=True)

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*found, strict=True) if found else [[]] * 4)], ["key", "ctx", "first", "last"])

    group: list[tuple] = []
    found: list[tuple] = []

    def close() -> None:
        if len(group) > 1 or group and group[0][3] > 1:
            for (key, ctx, *_), runs in zip(group, repeats([x[4] for x in group], [x[2] for x in group], [x[3] for x in group]), strict=True):
                found.extend((key, ctx, first, last) for first, last in runs)
        group.clear()

    for row in rows():
        if group and group[0][0] != row[0]:
            close()
            if len(found) > 50_000:
                yield batch(found)
                found.clear()
        group.append(row)
    close()
    yield batch(found)


def _sorted_runs(groups: DataFrame) -> DataFrame:
    dealt = groups.repartition("key").dropDuplicates(["key", "ctx"]).sortWithinPartitions("key")
    return dealt.select("key", "ctx", "geo", "copies", "piece").mapInArrow(_resolved, "key long, ctx long, first long, last long")


def _runs(groups: DataFrame, large: DataFrame) -> DataFrame:
    """key, ctx, first, last: runs of repeated starts in groups (key, ctx, geo, copies, piece, least, most); large: keys of groups to be split."""
    halves = written(groups.join(large, "key", "left_semi").mapInArrow(_halved, _HALVES))
    of_halves = halves.groupBy("key", "ctx").agg(*(F.first(k).alias(k) for k in ("geo", "piece", "least", "most")), F.sum("copies").alias("copies"))
    of_halves = written(of_halves.select("key", "ctx", "geo", "copies", "piece", "least", "most"))
    still = checkpointed(_large(of_halves))
    found = _sorted_runs(of_halves) if still.isEmpty() else _runs(of_halves, still)
    whole = halves.join(found, ["key", "ctx"]).select(F.col("up_key").alias("key"), F.col("up_ctx").alias("ctx"), (F.col("first") + F.col("shift")).alias("first"), (F.col("last") + F.col("shift")).alias("last"))
    return _sorted_runs(groups.join(large, "key", "left_anti")).union(whole)


def _large(groups: DataFrame) -> DataFrame:
    return groups.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > TOGETHER).select("key")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """rid, spans: for each text with repeated strings, the byte ranges [b, e) that they cover, in no order."""
    rows = texts(docs)
    found = rows.filter(F.octet_length("text") >= LENGTH).select("rid", "text").mapInArrow(_anchor_rows, "anchor long, ctx long, rid long, lo long, geo int")
    shared = found.groupBy("anchor").agg(F.count("*").alias("rows"), F.min("ctx").alias("c0"), F.max("ctx").alias("c1")).filter("rows > 1")
    shared = checkpointed(shared.select("anchor", (F.col("c0") == F.col("c1")).alias("alike")))
    held = written(found.join(shared, "anchor"))
    alike = held.filter("alike").select("rid", F.col("lo").alias("b"), F.expr(f"lo + geo % 256 + {LENGTH}").alias("e"))

    unlike = held.filter(~F.col("alike")).select(F.col("anchor").alias("key"), "ctx", "rid", "lo", "geo")
    one = unlike.groupBy("key", "ctx", "geo").agg(F.count("*").alias("copies"), F.min(F.struct("rid", "lo")).alias("at"))
    ask = one.groupBy(F.col("at.rid").alias("rid")).agg(F.collect_list(F.struct("key", "ctx", "geo", "copies", F.col("at.lo").alias("lo"))).alias("asked"))
    # equal rows have one rid: surroundings are taken from each of them, and are the same
    groups = rows.select("rid", "text").join(ask, "rid").select("text", "asked").mapInArrow(_surroundings, "key long, ctx long, geo int, copies long, piece binary")
    large = checkpointed(_large(one))
    if large.isEmpty():
        runs = _sorted_runs(groups)
    else:
        groups = groups.withColumn("least", F.lit(0)).withColumn("most", F.lit(WINDOW - 1))
        runs = _runs(written(groups.dropDuplicates(["key", "ctx"])), large)
    sorted_out = unlike.join(runs, ["key", "ctx"]).select("rid", F.expr("lo + first").alias("b"), F.expr(f"lo + last + {LENGTH}").alias("e"))
    return alike.union(sorted_out).groupBy("rid").agg(F.collect_set(F.struct("b", "e")).alias("spans"))


def _cut(text: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    if not spans:
        return text, []
    gone = _merged([(x["b"], x["e"]) for x in spans])
    kept = [text[e:b] for (_, e), (b, _) in zip([(0, 0), *gone], [*gone, (len(text), 0)], strict=True)]
    return b"".join(kept), gone


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, spans in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist(), strict=True):
            kept, gone = _cut(text, spans)
            rows.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
        cols = list(zip(*rows, strict=True)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row: what is left when repeated strings are cut out.

    Null text is empty (nothing removed, the digest of no bytes). A text of under 200 bytes has no string to remove.
    Repeated rows are copies of each other. Null doc_ids are kept. Other columns of docs are left aside.
    """
    joined = texts(docs).join(repeated_spans(docs), "rid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _kept_text(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([t if t is None or s is None else _cut(t.encode(), list(s))[0].decode(errors="ignore") for t, s in zip(text, spans, strict=True)], dtype=object)


def strip_repeats(docs: DataFrame) -> DataFrame:
    """docs with repeated strings cut out of text; a character that is cut in part goes as a whole. n_chars follows.

    A null text stays null, and counts as empty; repeated rows are copies of each other and lose what they share. An empty table
    stays empty. Columns of any other name are kept as they are.
    """
    rid = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    joined = docs.select(F.struct("*").alias("row"), rid.alias("rid")).join(repeated_spans(docs), "rid", "left")
    out = joined.select("row", F.pandas_udf(_kept_text, "string")("row.text", "spans").alias("kept"))
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.coalesce(F.length("kept"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(k, F.col(f"row.`{k}`")).alias(k) for k in docs.columns))
