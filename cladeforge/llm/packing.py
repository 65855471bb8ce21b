"""Packing of documents into sequences of bounded length by minimum bin slack.

Every document is tokenised once; of its ids only the digests of its pieces go on. Pieces of the whole length fill
sequences of their own. For the rest, the number of pieces of each length (at most `length` numbers, whatever the corpus)
decides everything: a window takes the longest length that is left, and a subset-sum program over bitsets finds the
multiset of lengths that comes closest to what remains; backtracking gives the counts. The same multiset is used for as
many sequences as the counts allow, so the plan has a few thousand lines at most. Pieces then find their places by their
rank among those of equal length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.llm.common import checkpointed, texts

LENGTH = 1024
END = b"\0\0\0\0"
#: Pieces that share a rank counter; the counters' totals are summed up in order.
RANKED_TOGETHER = 200_000
#: Distinct strings whose ids a worker remembers (twice: between spaces, and pre-tokens), which bounds its memory.
REMEMBERED = 700_000


class _Pieces(dict):
    """Ids (unsigned 32-bit, little endian) of a pre-token: byte-level BPE treats them one by one."""

    def __init__(self, tokenizer) -> None:  # noqa: ANN001
        self.model = tokenizer.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # byte-level alphabet: bytes shown as themselves; the others follow from 256 on
        others = [b for b in range(256) if b not in plain]
        self.shown = {b: b for b in plain} | {b: 256 + i for i, b in enumerate(others)}

    def __missing__(self, piece: str) -> bytes:
        ids = np.array([x.id for x in self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))], "<u4").tobytes()
        if len(self) < REMEMBERED:
            self[piece] = ids
        return ids


class _Ids(dict):
    """Ids of what follows a space. Pre-tokens begin at each space that stands alone, so texts can be cut there."""

    def __init__(self, tokenizer_path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.pieces = _Pieces(self.tokenizer)
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall  # the pattern of byte-level pre-tokens, a fixed value
        self.odd = ["\x1c", "\x1d", "\x1e", "\x1f", *(x.content for x in self.tokenizer.get_added_tokens_decoder().values())]
        settings = json.loads(self.tokenizer.to_str())
        level = settings["pre_tokenizer"] or {}
        self.plain = settings["normalizer"] is None and (level.get("type"), level.get("add_prefix_space"), level.get("use_regex")) == ("ByteLevel", False, True) and not settings["model"].get("ignore_merges")

    def cut(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def __missing__(self, word: str) -> bytes:
        ids = self.cut(" " + word)
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not self.plain or any(x in text for x in self.odd):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if "  " in text or text[-1:] == " ":
            return self.cut(text)
        first, *others = text.split(" ")
        return self.cut(first) + b"".join(map(self.__getitem__, others))


@cache
def _ids(tokenizer_path: str) -> _Ids:
    return _Ids(tokenizer_path)


def pieces(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """rid, doc_id, start, length, ids_crc32, doc_tokens of the pieces of each document: whole lengths, then the rest."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _ids(tokenizer_path)
        for batch in batches:
            rows = []
            for rid, doc_id, text in zip(*(batch.column(k).to_pylist() for k in ("rid", "doc_id", "text")), strict=True):
                own = ids.of(text) + END
                n = len(own) // 4
                rows += [(rid, doc_id, s, min(length, n - s), zlib.crc32(own[4 * s : 4 * (s + length)]), n) for s in range(0, n, length)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*rows, strict=True) if rows else [[]] * 6)], ["rid", "doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return texts(docs).mapInArrow(cut, "rid long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, within counts, whose sum is nearest to room and not over it."""
    reach, full, layers = 1, 1 << room, []
    mask = (full << 1) - 1
    for size in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        layers.append((size, reach))
        left, step = min(counts[size], room // size), 1
        while left:  # copies in binary portions
            step = min(step, left)
            reach |= (reach << (step * size)) & mask
            left -= step
            step *= 2
        if reach & full:
            break
    target, chosen = reach.bit_length() - 1, {}
    for size, before in reversed(layers):
        n = 0
        while not before >> (target - n * size) & 1:
            n += 1
        if n:
            chosen[size] = n
            target -= n * size
    return chosen


def plan(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Lines (piece length, first rank, first sequence, pieces of that length in a sequence, offset of the first)."""
    left = {x: n for x, n in counts.items() if n}
    taken = dict.fromkeys(left, 0)
    lines, sequence = [], 0
    while left:
        first = max(left)
        left[first] -= 1
        chosen = fill(left, length - first)
        left[first] += 1
        chosen[first] = chosen.get(first, 0) + 1
        times = min(left[x] // n for x, n in chosen.items())
        offset = 0
        for size in sorted(chosen, reverse=True):
            n = chosen[size]
            lines.append((size, taken[size], sequence, n, offset))
            offset += n * size
            taken[size] += times * n
            left[size] -= times * n
            if not left[size]:
                del left[size]
        sequence += times
    return lines


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece.

    A null or empty text is a document of one token, its end. Repeated rows and null doc_ids are documents like others.
    No documents give no rows. Other columns of docs are left aside.
    """
    held = checkpointed(pieces(docs, tokenizer_path, length))
    counts = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `length` rows at most
    lines = sorted(plan(counts, length))
    groups = max(1, sum(counts.values()) // RANKED_TOGETHER)
    named = held.withColumn("part", F.pmod(F.xxhash64("rid", "start"), F.lit(groups)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = named.groupBy("length", "part").agg(F.count("*").alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    rank = F.row_number().over(Window.partitionBy("length", "part").orderBy("rid", "start"))
    ranked = named.withColumn("rank", rank).join(bases, ["length", "part"]).withColumn("rank", F.expr("base + rank - 1"))
    sizes, firsts, sequences, numbers, offsets = (np.array(x, np.int64) for x in (zip(*lines, strict=True) if lines else [[]] * 5))
    width = max(1, sum(counts.values()) + 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sizes.astype(object) * width + firsts if width > 1 << 50 else sizes * width + firsts
        for batch in batches:
            own, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            line = np.searchsorted(keys, own * width + rank, "right") - 1
            local = rank - firsts[line]
            out = {"sequence_id": sequences[line] + local // numbers[line], "offset": offsets[line] + local % numbers[line] * own}
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")), *(pa.array(x) for x in out.values())], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *out])

    columns = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    return columns.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
