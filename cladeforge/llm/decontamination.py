"""Benchmark decontamination as a prefix-filtered set join with exact verification.

The shingles of a benchmark item are its words. A window is hit only where all of its words are found, so under any
order of the words the first one alone (a prefix of length n - n + 1) must be found: the rarest is taken. Windows are
indexed by it; where it is met in a document, its place in the window gives the one start that can match, the text's ends
bound it, and the words there are compared as a whole.

The index is sent to the tasks in blocks of bounded size. One block holds the usual benchmark; a larger one takes more
passes over the documents, and their hits are brought together by document.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeforge.llm.common import as_bytes, texts

WINDOW = 10
#: Windows in a block of the index (about 200 bytes each).
BLOCK_WINDOWS = 400_000
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Runs of letters, digits and what isn't ASCII, in lower case (A-Z)."""
    return text.translate(_FOLD).split()


def _windows(items: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), as_bytes(batch.column("text")), strict=True):
                w = words(text)
                if w:
                    rows += {(item, b" ".join(w[i : i + WINDOW])) for i in range(max(1, len(w) - WINDOW + 1))}
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.binary())], ["item", "window"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), text.alias("text")).mapInArrow(cut, "item string, window binary").distinct()


def _index(rows: list) -> dict[bytes, dict[tuple[int, int], dict[bytes, list[str]]]]:
    """Rarest word -> (its place, number of words) -> window -> items."""
    known: dict[bytes, list[str]] = {}
    for r in rows:
        known.setdefault(bytes(r["window"]), []).append(r["item"])
    rarity = Counter(w for x in known for w in set(x.split()))
    index: dict = {}
    for window, items in known.items():
        w = window.split()
        at = min(range(len(w)), key=lambda i: (rarity[w[i]], -len(w[i]), w[i], i))
        index.setdefault(w[at], {}).setdefault((at, len(w)), {})[window] = items
    return index


def find(w: list[bytes], index: dict) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged ranges of hit words, and the items met."""
    spans, items, n = [], set(), len(w)
    for i in [i for i, x in enumerate(w) if x in index]:
        for (at, size), there in index[w[i]].items():
            start = i - at
            if start >= 0 and start + size <= n and (met := there.get(b" ".join(w[start : start + size]))):
                spans.append((start, start + size))
                items.update(met)
    return _union(spans), items


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([b, e])
    return [(b, e) for b, e in out]


def _digest(n: int, spans: list[tuple[int, int]], items: set[str]) -> tuple:
    hit = sum(e - b for b, e in spans)
    return n, hit, len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), hit > 0


_OUT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())


def _scored(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    windows = _windows(benchmark)
    n = windows.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    rows = texts(docs)
    named = ["rid", *(x.split()[0] for x in _OUT.split(", "))]
    if blocks == 1:
        shared = docs.sparkSession.sparkContext.broadcast(_index(windows.collect()))  # BLOCK_WINDOWS rows at most

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for text in as_bytes(batch.column("text")):
                    w = words(text)
                    found.append(_digest(len(w), *find(w, shared.value)))
                cols = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(cols, _TYPES, strict=True))], named)

        return rows.mapInArrow(scan, f"rid long, {_OUT}")

    windows = windows.withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
    parts = []
    for block in range(blocks):
        index = docs.sparkSession.sparkContext.broadcast(_index(windows.filter(F.col("block") == block).collect()))

        def hits(batches: Iterator[pa.RecordBatch], index=index, count=block == 0) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for batch in batches:
                found = []
                for rid, text in zip(batch.column("rid").to_pylist(), as_bytes(batch.column("text")), strict=True):
                    spans, items = find(w := words(text), index.value)
                    if spans or count:
                        found.append((rid, len(w), [x for s in spans for x in s], sorted(items)))
                cols = list(zip(*found, strict=True)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string())), strict=True)], ["rid", "n", "spans", "items"])

        parts.append(rows.mapInArrow(hits, "rid long, n long, spans array<long>, items array<string>"))
    every = parts[0]
    for part in parts[1:]:
        every = every.union(part)
    met = every.groupBy("rid").agg(F.max("n").alias("n"), F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, spans, items in zip(*(batch.column(k).to_pylist() for k in ("n", "spans", "items")), strict=True):
                found.append(_digest(n, _union(list(zip(spans[::2], spans[1::2], strict=True))), set(items)))
            cols = list(zip(*found, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), *(pa.array(x, t) for x, t in zip(cols, _TYPES, strict=True))], named)

    return rows.select("rid", "doc_id").join(met, "rid").select("rid", "doc_id", "n", "spans", "items").mapInArrow(close, f"rid long, {_OUT}")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of each row of docs.

    Null texts have no words: such a document isn't hit, such an item has no window. No items, no hits (the digest is that
    of no bytes). An item of under ten words is one window of all of them. Items with equal windows are all counted; a null
    item_id counts as the empty one. Repeated rows come back repeated. Other columns are left aside.
    """
    return _scored(docs, benchmark).drop("rid")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a window of the benchmark. Null texts hold none, equal rows stay or go together, other columns are kept."""
    bad = _scored(docs, benchmark).filter("contaminated").select("rid").distinct()
    rid = F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.select(F.struct("*").alias("row"), rid.alias("rid")).join(bad, "rid", "left_anti").select("row.*")
