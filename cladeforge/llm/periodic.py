"""Periodic runs of words, found in a grammar of the texts instead of in the texts.

The words of some documents are numbered and compressed by Re-Pair: pairs of neighbours that occur often become new symbols, until
no pair occurs twice. A round replaces every pair that is more frequent than
the pairs it overlaps, many at once; equally frequent ones stand in a mixed order, so that copies of a passage don't take a round a word. Documents that are worked on together share one grammar, so that copies are compressed into the same
symbols; no symbol reaches over the end of a document. What remains of a document is halved into a balanced tree.

Each boundary between two neighbouring words lies inside exactly one symbol of those above it in the derivation: the one that joins the part with
the left word to the part with the right one. So for each symbol, once, the runs are found that cross its boundary and lie within its
words; its places in the derivation carry them to the documents. A run comes whole from the lowest symbol that holds all of it, and
in parts from smaller ones; stretches of one period that overlap by the period or more are merged.

At a boundary, only periods come in question at which the words beside it recur: a run of four periods has two of them to one side of
any place in it. Periods are compared word by word, with no hashes.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cladeforge.llm.common import texts

#: A run has at least LEAST words and POWER periods.
LEAST, POWER = 6, 4
#: Periods below it are tried at each boundary; longer ones where GRAM words recur.
GRAM = 4
#: 2^32 by the golden ratio: multiples of it (modulo 2^32) mix the order of equally frequent pairs.
MIX = 0x9E3779B1
#: Words of documents that are worked on together.
TOGETHER = 400_000

Run = tuple[int, int, int]


class Grammar(NamedTuple):
    """Symbols by number: place of one occurrence, words of the left part, words of all; and all places of each."""

    at: np.ndarray
    left: np.ndarray
    size: np.ndarray
    symbols: np.ndarray
    places: np.ndarray


def repair(words: np.ndarray, document: np.ndarray) -> Grammar:
    """The grammar of numbered words; document: number of each word's document, in order."""
    first = free = int(words.max()) + 1 if len(words) else 0
    symbol, place, size = words.astype(np.int64), np.arange(len(words)), np.ones(len(words), np.int64)
    new = np.ones(len(words), bool)  # pairs (with the next symbol) not counted yet, or counted twice and more: what occurs once stays so
    made: list[tuple[np.ndarray, ...]] = []

    def replace(at: np.ndarray, numbers: np.ndarray) -> None:
        """Joins the symbols at places with their next ones; equal pairs have equal numbers."""
        nonlocal symbol, place, document, size, new, free
        joined = size[at] + size[at + 1]
        numbers, firsts = pd.factorize(numbers)
        one = np.empty(len(firsts), np.int64)
        one[numbers[::-1]] = np.arange(len(at))[::-1]
        made.append((place[at][one], size[at][one], joined[one], numbers + free - first, place[at]))
        symbol[at], size[at] = numbers + free, joined
        new[at] = new[at - 1] = True
        free += len(firsts)
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, place, document, size, new = symbol[keep], place[keep], document[keep], size[keep], new[keep]

    while len(symbol) > 1:
        open_ = np.flatnonzero(new[:-1] & (document[:-1] == document[1:]))
        pair, _ = pd.factorize(symbol[open_] * free + symbol[open_ + 1])
        often = np.bincount(pair)[pair]
        new[open_[often < 2]] = False
        open_, pair, often = open_[often > 1], pair[often > 1], often[often > 1]
        weight = np.zeros(len(symbol) + 2, np.int64)
        weight[open_ + 1] = often << 32 | pair * MIX % (1 << 32)
        # equal neighbours are one stretch of one symbol repeated: every second pair of it, if it outweighs what lies beside it
        begins = np.flatnonzero(weight[1:] != weight[:-1]) + 1
        height = weight[begins]
        wins = (height > weight[begins - 1]) & (height > np.append(weight[begins[1:]], 0))
        many = (np.diff(np.append(begins, len(weight)))[wins] + 1) // 2
        if not len(many):
            break
        at = np.repeat(begins[wins] - 1, many) + 2 * (np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many))
        named = np.zeros(len(symbol), np.int64)
        named[open_] = pair
        replace(at, named[at])
    while len(symbol) > 1:
        begins = np.flatnonzero(np.append(True, document[1:] != document[:-1]))
        nth = np.arange(len(symbol)) - np.repeat(begins, np.diff(np.append(begins, len(symbol))))
        at = np.flatnonzero((nth[:-1] % 2 == 0) & (document[:-1] == document[1:]))
        if not len(at):
            break
        replace(at, np.arange(len(at)))
    if not made:
        none = np.zeros(0, np.int64)
        return Grammar(none, none, none, none, none)
    return Grammar(*(np.concatenate(x) for x in zip(*made, strict=True)))


def _matches(words: np.ndarray, i: int, j: int, limit: int, step: int) -> int:
    """How many words from i on equal those from j on, at most limit; to the left if step is -1 (then beginning with the words before i and j)."""
    done, width = 0, 32
    while done < limit:
        width = min(width, limit - done)
        if step > 0:
            differ = words[i + done : i + done + width] != words[j + done : j + done + width]
        else:
            differ = (words[i - done - width : i - done] != words[j - done - width : j - done])[::-1]
        if differ.any():
            return done + int(differ.argmax())
        done += width
        width *= 4
    return limit


class Boundaries:
    """Runs that cross a boundary of a stretch of words."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        n = len(words)
        gram = words.astype(np.int64)
        width = 1
        while width < GRAM:
            pair, _ = pd.factorize(gram[: n - 2 * width + 1] * (gram.max() + 1 if n else 1) + gram[width : n - width + 1]) if n >= 2 * width else (np.zeros(0, np.int64), None)
            gram, width = pair, 2 * width
        self.gram = gram
        self.order = np.argsort(gram, kind="stable")
        self.rank = np.empty(len(gram), np.int64)
        self.rank[self.order] = np.arange(len(gram))
        self.ends = np.cumsum(np.bincount(gram)) if len(gram) else gram
        same = gram[self.order[1:]] == gram[self.order[:-1]]
        step = np.diff(self.order)[same]
        self.ahead, self.back = np.full(len(gram), n, np.int64), np.full(len(gram), n, np.int64)
        self.ahead[self.order[:-1][same]] = step
        self.back[self.order[1:][same]] = step

    def maybe(self, begin: np.ndarray, middle: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Which boundaries (between middle - 1 and middle) a run can cross that lies in [begin, end)."""
        words, most = self.words, (end - begin) // POWER
        out = np.zeros(len(begin), bool)
        last = len(words) - 1
        for q in range(1, GRAM):
            right, left = (most >= q) & (middle + 2 * q <= end), (most >= q) & (middle - 2 * q >= begin)
            for k in range(q):
                right &= words[np.minimum(middle + k, last)] == words[np.minimum(middle + q + k, last)]
                left &= words[np.maximum(middle - 1 - k, 0)] == words[np.maximum(middle - 1 - q - k, 0)]
            out |= right | left
        if len(self.gram):
            at = np.minimum(middle, len(self.gram) - 1)
            out |= (most >= GRAM) & (self.ahead[at] <= np.minimum(most, (end - middle) // 2))
            at = np.clip(middle - GRAM, 0, len(self.gram) - 1)
            out |= (most >= GRAM) & (middle - GRAM >= begin) & (self.back[at] <= np.minimum(most, (middle - begin) // 2))
        return out

    def _periods(self, place: int, most: int, sign: int) -> np.ndarray:
        """Distances of at most `most` at which the GRAM words at a place recur, ascending."""
        if most < GRAM or not 0 <= place < len(self.gram):
            return np.zeros(0, np.int64)
        own, gram = self.rank[place], self.gram[place]
        if sign > 0:
            near = self.order[own + 1 : self.ends[gram]]
            return near[: np.searchsorted(near, place + most, "right")] - place
        near = self.order[self.ends[gram - 1] if gram else 0 : own]
        return place - near[np.searchsorted(near, place - most) :][::-1]

    def runs(self, begin: int, middle: int, end: int) -> list[Run]:
        """(start, end, period) of the runs in [begin, end) that hold the words middle - 1 and middle, by their least periods."""
        words, found = self.words, {}
        for sign in (1, -1):
            room = (end - middle) // 2 if sign > 0 else (middle - begin) // 2
            most = min(room, (end - begin) // POWER)
            known = self._periods(middle if sign > 0 else middle - GRAM, most, sign)
            periods = np.concatenate([np.arange(1, min(GRAM, most + 1)), known[known >= GRAM]])
            while len(periods):
                q, periods = int(periods[0]), periods[1:]
                if sign > 0:
                    right = _matches(words, middle, middle + q, end - middle - q, 1)
                    if right < q:
                        continue
                    start, stop = middle - _matches(words, middle, middle + q, middle - begin, -1), middle + q + right
                    periods = periods[2 * periods > stop - middle]  # two of those would lie in this run: multiples of its period
                else:
                    left = _matches(words, middle - q, middle, middle - q - begin, -1)
                    if left < q:
                        continue
                    start, stop = middle - q - left, middle + _matches(words, middle - q, middle, end - middle, 1)
                    periods = periods[2 * periods > middle - start]
                if start < middle < stop and stop - start >= max(LEAST, POWER * q):
                    found[start, stop] = min(q, found.get((start, stop), q))
        return [(s, t, q) for (s, t), q in found.items()]


def find_runs(words: np.ndarray, document: np.ndarray) -> list[Run]:
    """(start, end, period) of all maximal runs of numbered words, places counted over all documents, by period and start."""
    g = repair(words, document)
    large = np.flatnonzero(g.size >= LEAST)
    if not len(large):
        return []
    seek = Boundaries(words)
    begin, middle, end = g.at[large], g.at[large] + g.left[large], g.at[large] + g.size[large]
    with_runs: dict[int, list[Run]] = {}
    for i in np.flatnonzero(seek.maybe(begin, middle, end)).tolist():
        own = seek.runs(int(begin[i]), int(middle[i]), int(end[i]))
        if own:
            with_runs[int(large[i])] = [(s - int(begin[i]), t - int(begin[i]), q) for s, t, q in own]
    held = np.zeros(len(g.at), bool)
    held[list(with_runs)] = True
    uses = np.flatnonzero(held[g.symbols])
    stretches = [(q, place + s, place + t) for x, place in zip(g.symbols[uses].tolist(), g.places[uses].tolist(), strict=True) for s, t, q in with_runs[x]]
    merged: list[Run] = []
    for q, s, t in sorted(set(stretches)):
        if merged and merged[-1][2] == q and s + q <= merged[-1][1]:
            merged[-1] = merged[-1][0], max(t, merged[-1][1]), q
        else:
            merged.append((s, t, q))
    return merged


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place of a document of n words that is made periodic; None for all others."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def _sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


Change = Callable[[int | None, int], np.ndarray | None]


def _split(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Numbers of the words of all texts on end, the words, and where each text's words begin and end."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(column.cast(pa.large_string())))
    flat, begins = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    begins = begins - begins[0] if len(begins) else np.zeros(1, np.int64)
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not filled.all():  # texts without words
        before = np.concatenate([[0], np.cumsum(filled)])
        flat, begins = flat.filter(pa.array(filled)), before[begins]
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), flat, begins


def _groups(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about TOGETHER words (six bytes each)."""
    begin = size = 0
    lengths = pc.binary_length(batch.column("text")).to_pylist()
    for i, n in enumerate(lengths):
        size += n
        if size >= 6 * TOGETHER or i + 1 == len(lengths):
            yield batch.slice(begin, i + 1 - begin)
            begin, size = i + 1, 0


def _work(rows: pa.RecordBatch, change: Change | None) -> Iterator[tuple[int | None, list[Run], str]]:
    """doc_id, runs (start, length, period; by start, then period) and the kept words of each document, joined by spaces."""
    ids = rows.column("doc_id").to_pylist()
    words, flat, begins = _split(rows.column("text"))
    sources: dict[int, np.ndarray] = {}
    for i, doc_id in enumerate(ids if change else []):
        s, t = begins[i], begins[i + 1]
        source = change(doc_id, int(t - s))
        if source is not None:
            sources[i] = source
            words[s:t] = words[s:t][source]
    document = np.repeat(np.arange(len(ids)), np.diff(begins))
    own: dict[int, list[Run]] = defaultdict(list)
    kept = np.ones(len(words), bool)
    for s, t, q in find_runs(words, document):
        i = int(document[s])
        own[i].append((s - int(begins[i]), t - s, q))
        kept[s + q : t] = False
    places = np.arange(len(words))
    for i, source in sources.items():
        places[begins[i] : begins[i + 1]] = begins[i] + source
    after = np.concatenate([[0], np.cumsum(kept)])[begins]
    flat = flat if not sources and kept.all() else flat.take(pa.array(places[kept]))
    texts_ = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(after), flat), pa.scalar(" ", pa.large_string())).to_pylist()
    for i, doc_id in enumerate(ids):
        yield doc_id, sorted(own.get(i, []), key=lambda r: (r[0], r[2])), texts_[i]


def periodic_runs(docs: DataFrame, change: Change | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period by start, then period), collapsed text of each row of docs.

    A run is a stretch of words with a smallest period q and max(6, 4 q) words or more that can't grow on either side. collapsed: the
    words, joined by one space, without those that a run holds after its first period. Null and empty texts have no words: no runs
    and an empty text. Repeated rows and null doc_ids are rows like others; other columns are left aside; no rows give none.
    change: for a doc_id and a number of words, which word stands at each place instead, or None.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))), ("collapsed", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _groups(batch):
                out = [(d, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], text) for d, runs, text in _work(rows, change)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return texts(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def run_digests(docs: DataFrame, change: Change | None = planted) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the longest run (of several the first, then that of the least period), and digests of all
    runs and of the collapsed text, with the results of `periodic_runs` for odd rows; without a run the four are null."""
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    types = [pa.int64()] * 6 + [pa.string()] * 2

    def line(doc_id: int | None, runs: list[Run], text: str) -> tuple:
        start, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        return doc_id, len(runs), start, length, q, 1000 * length // q if runs else None, _sha(listed), _sha(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _groups(batch):
                out = [line(*x) for x in _work(rows, change)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return texts(docs).select("doc_id", "text").mapInArrow(run, ", ".join(f"{n} {'string' if 'sha' in n else 'long'}" for n in names))
