"""Documents scored by prediction by partial matching over bytes, with a trie learned from all training documents.

Texts are lower-cased (A-Z) and end in byte 255, which UTF-8 doesn't have; before its first byte a text is preceded by ORDER
such bytes. A byte's probability in the longest context known is count / (total + kinds); else the escape kinds /
(total + kinds) is paid and the next shorter context asked, without the bytes that the longer one has already ruled out
(symbol exclusion); at last, what no context knows shares what is left evenly.

The trie is a table, as large as the corpus makes it: tasks count the strings of ORDER + 1 bytes, Spark sums them up, and
strings of each shorter order from those of the longer one. No string is left out. As a string's probability depends on the string alone, it
is looked up once for every distinct string of the corpus, by joins of a string with its endings and of a context with its
followers; the costs of escapes are summed up along a context's endings, so that the way down takes one lookup.

Documents are dealt into buckets of some BUCKET_BYTES. Each asks for its distinct strings and its distinct words (by 63-bit hash),
and gets the answers with its documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeforge.llm.common import as_bytes, checkpointed, flat_bytes, id_part, texts

ORDER = 5
BUCKET_BYTES = 24 << 20
#: Bytes of texts cut into strings together, strings looked up together, and distinct strings that a task holds back to count.
CHUNK, PIECE, HELD = 1 << 19, 1 << 17, 1 << 20
_END = b"\xff"
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def grams(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte of lower-cased texts and their ends: the ORDER bytes before it and itself, as one number; and where texts begin in this."""
    data = np.frombuffer(_END * ORDER + (_END * (ORDER + 1)).join(raw).lower() + _END, np.uint8).astype(np.uint64)
    code, have, left = data, 1, data
    for bit in bin(ORDER + 1)[3:]:  # strings twice as long, and one longer where the number of bytes is odd
        code = (code[: len(code) - have] << np.uint64(8 * have)) | code[have:]
        have *= 2
        if bit == "1":
            code = (code[: len(code) - 1] << np.uint64(8)) | left[have:]
            have += 1
    lengths = np.array([len(x) + 1 for x in raw], np.int64)
    begins = np.cumsum(lengths) - lengths
    # between texts stand ORDER end bytes that aren't predicted
    gaps = (begins[1:] + ORDER * np.arange(len(raw) - 1))[:, None] + np.arange(ORDER)
    predicted = np.ones(len(code), bool)
    predicted[gaps.ravel()] = False
    return code[predicted], begins


def _parts(raw: list[bytes]) -> Iterator[tuple[int, int]]:
    """Runs of texts of some CHUNK bytes."""
    i = 0
    while i < len(raw):
        j, n = i + 1, len(raw[i])
        while j < len(raw) and n + len(raw[j]) <= CHUNK:
            n += len(raw[j])
            j += 1
        yield i, j
        i = j


def _slices(column: pa.Array, *others: pa.Array) -> Iterator[tuple]:
    """Runs of texts of some 8 * CHUNK bytes as Python's, and what stands beside them; never all of a batch or bucket."""
    _, begins = flat_bytes(column)
    at = 0
    while at < len(column):
        end = max(at + 1, int(np.searchsorted(begins, begins[at] + 8 * CHUNK, "right")) - 1)
        yield as_bytes(column[at:end]), *(x[at:end] for x in others)
        at = end


class Strings:
    """A set of 64-bit numbers (all but 2^64 - 1) by open addressing, for many at once; each has a slot, and a count there if they are of a kind."""

    def __init__(self, room: int = 0, kind: type | None = None) -> None:
        self.bits, self.kind = max(12, int(2 * room).bit_length()), kind
        self.held, self.n = np.full(1 << self.bits, _FREE), 0
        self.counts = np.zeros(1 << self.bits if kind else 0, kind or np.int64)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def found(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the keys, 0 of those that aren't held; nothing is taken in."""
        slot = self._first(keys)
        left = np.flatnonzero((self.held[slot] != keys) & (self.held[slot] != _FREE))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.held) - 1)
            s = slot[left]
            left = left[(self.held[s] != keys[left]) & (self.held[s] != _FREE)]
        return self.counts[slot]  # a free slot's is 0

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys, which hold until more come; new ones are taken in. The table grows before it could be half full."""
        if 2 * (self.n + len(keys)) > len(self.held):
            used = np.flatnonzero(self.held != _FREE)
            keep, counts = self.held[used], self.counts[used] if self.kind else None
            self.__init__(self.n + len(keys), self.kind)
            slots = self.slots(keep)
            if self.kind:
                self.counts[slots] = counts
        slot = self._first(keys)
        left = np.flatnonzero(self.held[slot] != keys)
        while len(left):
            s, k = slot[left], keys[left]
            free = self.held[s] == _FREE
            taken = s[free]
            self.held[taken] = k[free]  # of several, the last one stays
            taken.sort()
            self.n += int(len(taken) > 0) + int(np.count_nonzero(taken[1:] != taken[:-1]))
            lost = self.held[s] != k
            left = left[lost]
            slot[left] = (slot[left] + 1) & (len(self.held) - 1)
        return slot

    @property
    def used(self) -> np.ndarray:
        return np.flatnonzero(self.held != _FREE)


def _taken(every: Strings, raw: list[bytes], count: bool = False) -> None:
    for i, j in _parts(raw):
        codes, _ = grams(raw[i:j])
        for at in range(0, len(codes), PIECE):
            slots = every.slots(codes[at : at + PIECE])
            if count:
                np.add.at(every.counts, slots, 1)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def close(every: Strings) -> pa.RecordBatch:
        used = every.used
        return pa.RecordBatch.from_arrays([pa.array(every.held[used].view(np.int64)), pa.array(every.counts[used])], ["s", "n"])

    every = Strings(kind=np.int64)
    for batch in batches:
        for raw, held_out in _slices(batch.column("text"), batch.column("held_out")):
            held_out = held_out.to_pylist()
            for side in (False, True):
                _taken(every, [x for x, h in zip(raw, held_out, strict=True) if h == side], count=not side)
            if every.n > HELD:
                yield close(every)
                every = Strings(kind=np.int64)
    yield close(every)


def _last(column: Column, n: int) -> Column:
    """The last n bytes of a string."""
    return column.bitwiseAND(F.lit((1 << 8 * n) - 1))


def count_strings(rows: DataFrame) -> DataFrame:
    """s, n of each distinct string of ORDER + 1 bytes of rows (text, held_out): how often it is found in rows that aren't held out."""
    return rows.select("held_out", "text").mapInArrow(_counted, "s long, n long").groupBy("s").agg(F.sum("n").alias("n"))


def probabilities(counted: DataFrame) -> DataFrame:
    """s, log of each string of counted (s, n): log10 of the probability of its last byte after the others.

    Strings of n = 0 aren't learned from.
    """
    strings = {ORDER: counted.filter("n > 0")}
    for k in range(ORDER, 0, -1):
        strings[k - 1] = checkpointed(strings[k].groupBy(_last(F.col("s"), k).alias("s")).agg(F.sum("n").alias("n")))
    # of a context: base and escape when nothing is ruled out; way: escapes of all orders below, each without what the order
    # above it has; after: what a byte found one order lower pays, with the way that is then not gone taken off
    contexts = {}
    for k in range(ORDER + 1):
        own = strings[k].withColumn("c", F.shiftright("s", 8))
        if k:
            lower = strings[k - 1].select(F.col("s").alias("short"), F.col("n").alias("lower"))
            own = own.join(lower, _last(F.col("s"), k) == F.col("short"))
        else:
            own = own.withColumn("lower", F.lit(0))
        stats = own.groupBy("c").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("lower").alias("ruled"))
        if k:
            below = contexts[k - 1].select(F.col("c").alias("short"), F.col("total").alias("total_below"), F.col("kinds").alias("kinds_below"), F.col("way").alias("way_below"))
            stats = stats.join(below, _last(F.col("c"), k - 1) == F.col("short"))
            total, kinds = F.col("total_below") - F.col("ruled"), F.col("kinds_below") - F.col("kinds")
            rest = F.when(total > 0, F.log10(total + kinds)).otherwise(0.0)
            stats = stats.withColumn("rest", rest).withColumn("way", F.col("way_below") - F.col("rest") + F.when(total > 0, F.log10(F.greatest(kinds, F.lit(1)))).otherwise(0.0))
            stats = stats.withColumn("after", -F.col("way") - F.col("rest"))
        else:
            stats = stats.withColumn("way", F.lit(0.0)).withColumn("after", F.lit(0.0))
        stats = stats.select("c", "total", "kinds", "way", "after", F.log10(F.col("total") + F.col("kinds")).alias("base"), F.log10("kinds").alias("escape"))
        contexts[k] = checkpointed(stats)
    known = strings[ORDER].join(contexts[ORDER].select("c", "base"), F.shiftright("s", 8) == F.col("c")).select("s", (F.log10("n") - F.col("base")).alias("log"))
    asked = counted.filter("n = 0").select("s")
    for k in range(ORDER, 0, -1):
        c = contexts[k].select(F.col("c").alias(f"c{k}"), F.col("base").alias(f"base{k}"), F.expr("escape - base + way").alias(f"way{k}"), F.col("after").alias(f"after{k}"))
        asked = asked.join(c, _last(F.shiftright("s", 8), k) == F.col(f"c{k}"), "left").drop(f"c{k}")
    for k in range(ORDER - 1, -1, -1):
        n = strings[k].select(F.col("s").alias("short"), F.log10("n").alias(f"n{k}"))
        asked = asked.join(n, _last(F.col("s"), k + 1) == F.col("short"), "left").drop("short")
    root = contexts[0].first()  # one row at most
    if root is None:
        return counted.select("s", F.lit(-math.log10(256)).alias("log"))
    way0, bottom = root["escape"] - root["base"], -math.log10(max(1, 256 - root["kinds"]))
    way = F.coalesce(*(F.col(f"way{k}") for k in range(ORDER, 0, -1)), F.lit(way0))
    found = F.lit(None).cast("double")
    for k in range(ORDER):  # the longest string known comes last
        plain = F.col(f"n{k}") - (F.col(f"base{k}") if k else F.lit(root["base"]))
        found = F.when(F.col(f"n{k}").isNotNull(), F.when(F.col(f"way{k + 1}").isNull(), plain).otherwise(way + F.col(f"after{k + 1}") + F.col(f"n{k}"))).otherwise(found)
    return known.union(asked.select("s", F.coalesce(found, way + F.lit(bottom)).alias("log")))


#: Words' names are told from strings by being below zero.
_WORD = np.uint64(1 << 63)
_END_WORD = np.uint64(xxhash.xxh3_64_intdigest(b"") >> 1) | _WORD
_SPACE = np.isin(np.arange(256), list(b" \t\n\v\f\r"))
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Words of more bytes are hashed one by one.
LONG = 64


def _names(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """63 bits of the hashes of lower-cased texts' words, one after the other, marked as words; and how many each text has."""
    data = np.frombuffer(b"".join(y for x in raw for y in (x, b" ")).lower() + bytes(8), np.uint8)
    turns = np.flatnonzero(np.diff(_SPACE[data[:-8]], prepend=True))  # words begin and end by turns; each text ends in a space
    begins, ends = turns[::2], turns[1::2]
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    sizes = ends - begins
    names = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    left = np.flatnonzero(sizes <= LONG)
    for at in range(0, LONG, 8):
        x = names[left] ^ (eight[begins[left] + at] & _FIRST[np.minimum(sizes[left] - at, 8)])
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        names[left] = x ^ (x >> np.uint64(31))
        left = left[sizes[left] > at + 8]
    for i in np.flatnonzero(sizes > LONG):
        names[i] = xxhash.xxh3_64_intdigest(data[begins[i] : ends[i]])
    return np.minimum((names >> np.uint64(1)) | _WORD, _FREE - np.uint64(1)), np.diff(np.searchsorted(begins, np.cumsum([len(x) + 1 for x in raw])), prepend=0)


def _asked(bucket: pa.Table) -> pa.Table:
    words, strings, ends = Strings(kind=np.int64), Strings(), 0
    for raw, held_out in _slices(bucket.column("text").combine_chunks(), bucket.column("held_out").combine_chunks()):
        training = ~held_out.to_numpy(zero_copy_only=False)
        ends += int(training.sum())
        names, sizes = _names(raw)
        learned = np.repeat(training.astype(np.int64), sizes)
        for at in range(0, len(names), PIECE):
            slots = words.slots(names[at : at + PIECE])
            np.add.at(words.counts, slots, learned[at : at + PIECE])
        _taken(strings, raw)
    keys = np.concatenate((words.held[words.used], [_END_WORD], strings.held[strings.used])).view(np.int64)
    c = np.concatenate((words.counts[words.used], [ends], np.zeros(strings.n, np.int64)))
    return pa.table({"bucket": pa.array(np.full(len(keys), bucket.column("bucket")[0].as_py(), np.int64)), "key": pa.array(keys), "c": pa.array(c)})


_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("known", pa.float64()), ("score", pa.float64())])


def _scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """known: the sum of log10(c + 1) over the tokens."""
    if not docs.num_rows:
        return _OUT.empty_table()
    key = answers.column("key").to_numpy()
    is_word = key < 0
    names, counts = key[is_word].view(np.uint64), answers.column("n").to_numpy()[is_word]
    end = math.log10(int(counts[names == _END_WORD].sum()) + 1)
    words = Strings(len(names), np.int64)
    slots = words.slots(names)
    words.counts[slots] = counts
    strings = key[~is_word].view(np.uint64)
    logs = Strings(len(strings), np.float32)
    slots = logs.slots(strings)
    logs.counts[slots] = answers.column("log").to_numpy()[~is_word]
    del key, is_word, strings, slots, names, counts, answers
    tokens, hits, known, scores = [], [], [], []
    for (raw,) in _slices(docs.column("text").combine_chunks()):
        names, sizes = _names(raw)
        n = np.concatenate([words.found(names[x : x + PIECE]) for x in range(0, len(names), PIECE)] + [[0]])  # a last one, as reduceat wants a place even for no words
        of_text = np.cumsum(sizes) - sizes
        tokens.append(sizes + 1)
        hits.append(np.where(sizes > 0, np.add.reduceat(n > 0, of_text, dtype=np.int64), 0) + (end > 0))
        known.append(np.where(sizes > 0, np.add.reduceat(np.log10(n + 1.0), of_text), 0.0) + end)
        for i, j in _parts(raw):
            codes, begins = grams(raw[i:j])
            found = np.concatenate([logs.found(codes[x : x + PIECE]) for x in range(0, len(codes), PIECE)])
            scores.append(np.add.reduceat(found, begins, dtype=np.float64))
    return pa.Table.from_arrays([docs.column("doc_id"), docs.column("held_out"), *(pa.array(np.concatenate(x)) for x in (tokens, hits, known, scores))], schema=_OUT)


def score_texts(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

    A null text is empty: one token, its end. Without training documents nothing is known; the base gives every token
    log10(1/(0 + 1)) = 0, and the model shares evenly among bytes. Repeated rows are documents like others (those in
    training count each time). Null doc_ids count as the empty text's crc32. Other columns are left aside.
    """
    rows = texts(docs).withColumn("held_out", id_part(7) == 2)
    n_bytes = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    logs = probabilities(checkpointed(count_strings(rows)))
    dealt = rows.select(F.pmod(F.xxhash64("rid", F.lit(6)), F.lit(max(1, n_bytes // BUCKET_BYTES))).alias("bucket"), "doc_id", "held_out", "text")
    asked = dealt.groupBy("bucket").applyInArrow(_asked, "bucket long, key long, c long")
    by_key = Window.partitionBy("key")
    asked = asked.withColumn("n", F.sum("c").over(by_key)).withColumn("first", F.min("bucket").over(by_key))
    # both totals are read off the same exchange as the answers, so documents are asked once
    word = F.col("key") < 0
    totals = asked.agg(F.coalesce(F.sum(F.when(word, F.col("c"))), F.lit(0)).alias("N"), F.count(F.when(word & (F.col("n") > 0) & (F.col("bucket") == F.col("first")), 1)).alias("V"))
    both = totals.select(F.struct("N", "V").alias("both")).scalar()
    answers = asked.join(logs.withColumnRenamed("s", "key"), "key", "left").filter("log is not null or n > 0").select("bucket", "key", "n", F.col("log").cast("float").alias("log"))
    scored = dealt.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(_scored, "doc_id long, held_out boolean, n_tokens long, n_known long, known double, score double")
    rows = scored.withColumn("both", both)
    base = F.col("known") - F.col("n_tokens") * F.log10(F.col("both.N") + F.col("both.V") + 1)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.col("both.N").alias("train_tokens"), base.alias("base_score"), "score")
