"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text is normalised, its characters become symbols, and an agenda holds the adjacent pairs of symbols whose
concatenation is a piece. The pair of the best score (of several, the leftmost) is merged first, and the pairs that the
merged symbol makes with its neighbours join the agenda; pairs whose symbols have changed meanwhile are passed over. What
is left becomes ids, unknown characters their bytes.

A text falls into chunks with agendas of their own where no merge can cross: before a space mark, if no piece has one after
another character, and between characters that no piece links, directly or over others (letters and punctuation, usually).
A worker remembers the ids of chunks. Where a vocabulary or its normalisation is of another kind, a whole text is one chunk.

Every chunk that a worker meets and doesn't remember is held against the sentencepiece library, all those of a part of an
Arrow batch at once. A difference is an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from cladeforge.llm.common import texts

MARK = "▁"
#: Chunks whose ids a worker remembers, which bounds its memory; longer chunks than CHUNK are never remembered.
REMEMBERED, CHUNK = 600_000, 64
#: Characters of texts that are worked on together.
TOGETHER = 1 << 20

Entry = tuple[str, tuple[int, ...]]


def _linked(pieces: Iterable[str]) -> list[set[str]]:
    """Sets of characters that stand side by side in pieces, directly or over others; space marks aside."""
    root: dict[str, str] = {}

    def find(x: str) -> str:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in {x for p in pieces for x in zip(p, p[1:], strict=False)}:
        if MARK not in (a, b):
            root[find(a)] = find(b)
    sets: dict[str, set[str]] = {}
    for x in list(root):
        sets.setdefault(find(x), set()).add(x)
    return list(sets.values())


class Vocabulary:
    """Pieces, scores and normalisation of a model file."""

    def __init__(self, model_path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.library.serialized_model_proto())
        if model.trainer_spec.model_type != model.trainer_spec.BPE:
            raise ValueError("a merge-type vocabulary is needed")
        kind = sentencepiece_model_pb2.ModelProto.SentencePiece
        if any(p.type == kind.USER_DEFINED for p in model.pieces):
            raise ValueError("user-defined pieces aren't supported")
        numbered = list(enumerate(model.pieces))
        self.merged = {p.piece: (p.score, i) for i, p in numbered if p.type in (kind.NORMAL, kind.UNUSED)}
        self.ids = {p.piece: i for i, p in numbered}
        self.unused = {p.piece for p in model.pieces if p.type == kind.UNUSED}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in numbered if p.type == kind.BYTE}
        self.unknown = self.library.unk_id()
        spec = model.normalizer_spec
        self.plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces and spec.add_dummy_prefix and not model.trainer_spec.treat_whitespace_as_suffix
        self.chunked = self.plain and bool(self.bytes) and not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.merged)
        if self.chunked:
            classes = "".join(f"[{''.join(map(re.escape, sorted(x)))}]+|" for x in _linked(self.merged))
            self.chunks = re.compile(f"{MARK}*(?:{classes}[^{MARK}])|{MARK}+", re.DOTALL).findall
            used = set(chain.from_iterable(self.merged))
            self.guard = next(x for x in map(chr, range(0xE000, 0xF8FF)) if x not in used)  # a character of private use that no piece has

    def normalise(self, text: str) -> str:
        if not text:
            return ""
        return MARK + text.replace(" ", MARK) if self.plain else self.library.normalize(text)

    def cut(self, text: str) -> list[str]:
        """The chunks of a text, normalised."""
        whole = self.normalise(text)
        return self.chunks(whole) if self.chunked else [whole] if whole else []

    def theirs(self, chunks: list[str], batch: list[str]) -> dict[str, list[int]]:
        """The library's ids of chunks, set off by a character that no merge reaches; if texts aren't cut, of the batch's texts."""
        if not self.chunked:
            own = {self.normalise(t): t for t in batch}
            return dict(zip(chunks, self.library.encode([own[c] for c in chunks], num_threads=1), strict=True))
        skip = len(self.library.encode(self.guard))
        found = self.library.encode([self.guard + c.replace(MARK, " ") for c in chunks], num_threads=1)
        return {c: x[skip:] for c, x in zip(chunks, found, strict=True)}

    def encode(self, chunk: str) -> list[int]:
        """Ids of a chunk."""
        if chunk in self.merged and chunk not in self.unused and len(chunk) < 2:
            return [self.ids[chunk]]
        symbols, end, get, unused = list(chunk), len(chunk), self.merged.get, self.unused
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        parts: dict[str, tuple[str, str]] = {}
        # lines of the agenda: score with its sign turned, place of the left symbol and of the right one, length of both
        agenda = [(-found[0], i, i + 1, 2) for i in range(end - 1) if (found := get(chunk[i : i + 2]))]
        if unused:
            parts |= {x: (x[0], x[1]) for x in map("".join, zip(chunk, chunk[1:], strict=False)) if x in unused}
        heapify(agenda)
        while agenda:
            _, left, right, size = heappop(agenda)
            both = symbols[left] + symbols[right]
            if len(both) != size or not symbols[left] or not symbols[right]:
                continue
            symbols[left], symbols[right] = both, ""
            further = after[left] = after[right]
            if further < end:
                before[further] = left
            for a, b in ((before[left], left), (left, further)):
                if a >= 0 and b < end and (found := get(new := symbols[a] + symbols[b])):
                    heappush(agenda, (-found[0], a, b, len(new)))
                    if new in unused:
                        parts[new] = symbols[a], symbols[b]
        out: list[int] = []
        for symbol in symbols:
            if symbol:
                self._write(symbol, parts, out)
        return out

    def _write(self, symbol: str, parts: dict[str, tuple[str, str]], out: list[int]) -> None:
        if symbol in self.merged and symbol not in self.unused:
            out.append(self.ids[symbol])
            return
        stack = [symbol]
        while stack:
            symbol = stack.pop()
            if symbol in self.unused and symbol in parts:
                stack += reversed(parts[symbol])
                continue
            found = self.ids.get(symbol, self.unknown)
            if found != self.unknown:
                out.append(found)
            elif self.bytes:
                out += (self.bytes[b] for b in symbol.encode())
            elif not out or out[-1] != found:  # unknown ones in a row are one
                out.append(found)


class Encoder:
    """Entries (decimal ids joined by commas, ids) of chunks, remembered up to a bound."""

    def __init__(self, model_path: str) -> None:
        self.vocabulary = Vocabulary(model_path)
        self.known: dict[str, Entry] = {}

    def entries(self, batch: list[str]) -> Iterator[list[Entry]]:
        """For each text its chunks' entries. Chunks that aren't remembered are encoded, and held against the library."""
        v, known = self.vocabulary, self.known
        cut = list(map(v.cut, batch))
        new = list(set(chain.from_iterable(cut)).difference(known))
        theirs = v.theirs(new, batch)
        fresh: dict[str, Entry] = {}
        for chunk in new:
            own = v.encode(chunk)
            if own != theirs[chunk]:
                raise AssertionError(f"the library has other ids for {chunk[:200]!r}: {theirs[chunk][:50]}, not {own[:50]}")
            fresh[chunk] = ",".join(map(str, own)), tuple(own)
        for chunk in new[: max(0, REMEMBERED - len(known))]:
            if len(chunk) <= CHUNK:
                known[chunk] = fresh.pop(chunk)
        for chunks in cut:
            yield [known[x] if x in known else fresh[x] for x in chunks] if fresh else [known[x] for x in chunks]


@cache
def _encoder(model_path: str) -> Encoder:
    return Encoder(model_path)


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows and texts of a batch, about TOGETHER characters at a time."""
    texts_, begin, size = batch.column("text"), 0, 0
    lengths = pc.binary_length(texts_).to_pylist()
    for i, n in enumerate(lengths):
        size += n
        if size >= TOGETHER or i + 1 == len(lengths):
            rows = batch.slice(begin, i + 1 - begin)
            yield rows, rows.column("text").to_pylist()
            begin, size = i + 1, 0


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (array of int), decoded (string) of each row of docs: the ids of the whole text and what they decode to.

    Null texts count as empty ones, which have no ids. Repeated rows and null doc_ids are rows like others; other columns of docs
    are left aside, whatever their names; no rows give none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            for rows, own in _groups(batch):
                ids = [list(chain.from_iterable(e[1] for e in x)) for x in encoder.entries(own)]
                decoded = encoder.vocabulary.library.decode(ids, num_threads=1) if ids else []
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])

    return texts(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of what `encode` returns, taken where the ids are made, with the same results for odd rows."""

    def digest(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model_path)
        for batch in batches:
            for rows, own in _groups(batch):
                named, ids = [], []
                for x in encoder.entries(own):
                    named.append(digest(",".join([e[0] for e in x])))
                    ids.append(list(chain.from_iterable([e[1] for e in x])))
                decoded = encoder.vocabulary.library.decode(ids, num_threads=1) if ids else []
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(list(map(len, ids)), pa.int64()), pa.array(named), pa.array(list(map(digest, decoded)), pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts(docs).select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
