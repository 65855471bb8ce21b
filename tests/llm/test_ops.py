"""Operators against brute force on small fixtures, and their defined results in odd cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from cladeforge.llm import chat, decontamination, language_id, license_texts, licenses, near_copies, near_simhash, packing, ppm, quality_model, quality_rules, simhash, suffix_dedup
from cladeforge.llm.queries import tokenizer_path
from cladeforge.llm.suffix_sort import blind_trie, deep_shallow

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, fp string, spans string"


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdeéß") for _ in range(r.randint(1, 7))) for _ in range(n))


def corpus():
    shared, line = words(60, 1), words(17, 2)
    texts = [words(120, 100 + i) for i in range(12)]
    texts += [texts[0], texts[0], texts[1][:400] + " xx " + texts[1][400:], texts[2] + shared, shared + texts[3], texts[4][:200] + shared + texts[5]]
    texts += [f"{words(10, 200 + i)}\n{line}\n{words(10, 300 + i)}" for i in range(30)]
    texts += [shared * 3, "a" * 1000, "ab" * 300, "", None, " \n\t ", "é" * 150, "x", words(5000, 9), texts[6].upper()]
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}", len(t or ""), "r", "f", "s") for i, t in enumerate(texts)]
    return [*rows, rows[3], (None, texts[7], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


# suffix arrays


def test_deep_shallow_sorts():
    r = random.Random(3)
    for _ in range(200):
        strings = [bytes(r.choice(b"ab") for _ in range(r.choice((0, 3, 9, 60)))) * r.choice((1, 5)) for _ in range(r.randint(1, 40))]
        for order in (deep_shallow(strings), deep_shallow(strings, 8), blind_trie(strings, list(range(len(strings))))):
            assert sorted(order) == list(range(len(strings)))
            assert [strings[i] for i in order] == sorted(strings)


def brute_repeats(rows, n=200):
    raw = [(t or "").encode() for _, t, *_ in rows]
    count = Counter(b[i : i + n] for b in raw for i in range(len(b) - n + 1))
    out = []
    for (doc_id, *_), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - n + 1):
            if count[b[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("together", [1_000, 3, 1])
def test_suffix_dedup(docs, monkeypatch, together):
    monkeypatch.setattr(suffix_dedup, "TOGETHER", together)
    assert found(suffix_dedup.without_repeats(docs)) == brute_repeats(corpus())


def test_halves_of_groups_cover_all_strings():
    import pyarrow as pa

    r = random.Random(6)
    core, rows = bytes(r.choice(b"xy") for _ in range(64)), []
    for i in range(40):
        at = r.randint(0, 136)
        further = r.randint(0, at)
        rows.append((7, i, at * 256 + further, 1, bytes(r.choice(b"pq") for _ in range(at)) + core + bytes(r.choice(b"pq") for _ in range(further + 136 - at)), 0, 136))
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int32())
    (out,) = suffix_dedup._halved(iter([pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], ["key", "ctx", "geo", "copies", "piece", "least", "most"])]))
    got = Counter()
    for x in out.to_pylist():
        for s in range(x["geo"] % 256 + 1):
            got[x["up_ctx"], x["shift"] + s, x["piece"][s : s + 200]] += 1
            assert x["least"] <= x["geo"] // 256 - s <= x["most"]
    assert got == Counter((ctx, s, piece[s : s + 200]) for _, ctx, geo, _, piece, *_ in rows for s in range(geo % 256 + 1))
    near = defaultdict(set)
    for x in out.to_pylist():
        near[x["key"]].add(x["piece"][x["geo"] // 256 - x["least"] :][: 200 - x["most"] + x["least"]])
    assert all(len(v) == 1 for v in near.values())


def test_suffix_dedup_chunks():
    r = random.Random(5)
    base = bytes(r.choice(b"abc") for _ in range(3000))
    data = np.frombuffer(base + base[:700] + base, np.uint8)
    begins = np.array([0, 3000, 3000, 3700, len(data)])
    for chunk in (300, 1 << 18):
        suffix_dedup._powers.cache_clear()
        keep, suffix_dedup.CHUNK = suffix_dedup.CHUNK, chunk
        starts = Counter()
        for _, _, text, lo, geo in suffix_dedup.anchors(data, begins):
            for t, s, g in zip(text, lo, geo, strict=True):
                starts.update((t, s + i) for i in range(g % 256 + 1))
        suffix_dedup.CHUNK = keep
        assert starts == Counter({(t, s): 1 for t in range(4) for s in range(begins[t + 1] - begins[t] - 199)})
    suffix_dedup._powers.cache_clear()


def test_large_groups_agree_with_pairs():
    r = random.Random(8)
    core = bytes(r.choice(b"xy") for _ in range(64))
    pieces, geos = [], []
    for _ in range(30):
        at, further = r.randint(0, 136), 0
        further = r.randint(0, at)
        left = bytes(r.choice(b"pq") if r.random() < 0.02 else 112 for _ in range(at))
        right = bytes(r.choice(b"pq") if r.random() < 0.02 else 112 for _ in range(further + 200 - at - 64))
        pieces.append(left + core + right)
        geos.append(at * 256 + further)
    copies = [1] * 29 + [2]
    count = defaultdict(set)
    for i, (p, g) in enumerate(zip(pieces, geos, strict=True)):
        for s in range(g % 256 + 1):
            count[g // 256 - s, p[s : s + 200]].add(i)
    want = [[s for s in range(g % 256 + 1) if copies[i] > 1 or len(count[g // 256 - s, p[s : s + 200]]) > 1] for i, (p, g) in enumerate(zip(pieces, geos, strict=True))]
    for n in (30, 9):
        got = suffix_dedup.repeats(pieces[-n:], geos[-n:], copies[-n:])
        if n == 30:
            assert [[s for a, b in runs for s in range(a, b + 1)] for runs in got] == want
    some = suffix_dedup.repeats(pieces[-12:], geos[-12:], copies[-12:])
    more = suffix_dedup.repeats(pieces[-12:] + [b"z" * 200], geos[-12:] + [0], copies[-12:] + [1])
    assert some == more[:12] and more[12] == []


def test_strip_repeats(docs):
    rows = {r["doc_id"]: r for r in suffix_dedup.strip_repeats(docs).collect()}
    assert suffix_dedup.strip_repeats(docs).columns == docs.columns
    assert rows[0]["text"] == "" and rows[8]["text"] == corpus()[8][1]
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows.values())


# simhash


def brute_components(rows):
    def words_of(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    prints = []
    for _, t, *_ in rows:
        w = words_of(t)
        s = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for _ in rows:
        for i in range(len(rows)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
    ids = defaultdict(list)
    for i, g in enumerate(group):
        ids[g].append(rows[i][0])
    least = {g: min((x for x in v if x is not None), default=None) for g, v in ids.items()}
    return sorted(((rows[i][0], f"{prints[i]:016x}", least[group[i]]) for i in range(len(rows))), key=repr)


@pytest.mark.parametrize("pairwise", [64, 1])
def test_simhash(docs, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    assert found(simhash.near_duplicates(docs)) == brute_components(corpus())


@pytest.mark.parametrize("pairwise", [64, 2])
def test_links_lose_nothing(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    r = random.Random(4)
    prints = {r.getrandbits(64) for _ in range(50)}
    for x in list(prints):
        for _ in range(6):
            x ^= 1 << r.randrange(64)
            x ^= (1 << r.randrange(64)) * r.randrange(2)
            prints.add(x)
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    root = dict((r["node"], r["root"]) for r in simhash.components(simhash.links(df)).collect())
    group = {x: x for x in signed}
    for _ in range(20):
        for i, x in enumerate(signed):
            for y in signed[:i]:
                if ((x ^ y) & (1 << 64) - 1).bit_count() <= 2:
                    group[x] = group[y] = min(group[x], group[y])
    assert {x: root.get(x, x) for x in signed} == group


def test_keep_one(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    component = {}
    for doc_id, f, c in brute_components(corpus()):
        component.setdefault((f, c), []).append(doc_id)
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({c for _, _, c in brute_components(corpus()) if c is not None})


def test_stage_keeps_one_by_jaccard(spark, monkeypatch):
    r = random.Random(8)
    rows = []
    for i in range(12):
        w = words(r.choice((20, 60, 150)), 700 + i).split()
        rows.append(" ".join(w))
        for n in (1, 1, 2, 3, 5):
            x = list(w)
            for at in r.sample(range(len(x)), n):
                x[at] = f"new{r.randrange(10**6)}"
            rows.append(" ".join(x))
        rows += [" ".join(w[:-1]), " ".join(["zz", *w]), " ".join(w[: len(w) * 7 // 10])]
    line = words(30, 900)
    rows += [f"{line} {words(n, 950 + n)}" for n in (1, 2, 3, 6, 8, 9, 20, 40)] * 2
    rows += ["", None, " \n", "a b", "A  b", "a b c", "a b c d e", "a b c d e f", rows[0].upper()]

    def shingles(t):
        w = (t or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for t in rows]
    group = list(range(len(rows)))
    alike = lambda a, b: 9 * len(a & b) >= 4 * (len(a) + len(b))
    near = [(i, j) for i in range(len(rows)) for j in range(i) if alike(sets[i], sets[j])]
    for _ in rows:
        for i, j in near:
            group[i] = group[j] = min(group[i], group[j])
    docs = spark.createDataFrame([(i, t, "en", "s", 0, "r", "f", "s") for i, t in enumerate(rows)], SCHEMA).repartition(3)
    for frequent, pairwise in ((near_copies.FREQUENT, near_copies.PAIRWISE), (1, 2)):
        monkeypatch.setattr(near_copies, "FREQUENT", frequent)
        monkeypatch.setattr(near_copies, "PAIRWISE", pairwise)
        kept = corpus_pipeline.near_dedup(spark, docs.union(docs.limit(3)), "")
        assert kept.columns == docs.columns
        assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(group))
    assert 20 < len(set(group)) < len(rows) - 40


def test_large_groups_of_near_copies(spark, monkeypatch):
    """Copies with one to seven words changed, and texts around one passage: the links of brute force, with far fewer pairs compared than there are."""
    r = random.Random(12)
    base, passage, texts = words(150, 77).split(), words(60, 78), []
    for i in range(330):
        w = list(base)
        for at in r.sample(range(150), r.choice((0, 1, 1, 2, 3, 4, 5, 7))):
            w[at] = f"new{r.randrange(40)}"
        texts.append(" ".join(w))
    texts += [f"{words(r.choice((3, 40)), 500 + i)} {passage} {words(r.choice((2, 30)), 900 + i)}" for i in range(120)]
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    group = list(range(len(texts)))

    def root(i):
        while group[i] != i:
            group[i] = i = group[group[i]]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j])):
                x, y = sorted((root(i), root(j)))
                group[y] = x
    compared = []
    real = near_copies.checkpointed
    monkeypatch.setattr(near_copies, "checkpointed", lambda df: [out := real(df), compared.append(out.count()) if df.columns == ["a", "b"] else None][0])
    kept = near_copies.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(i for i in range(len(texts)) if root(i) == i)
    assert sum(compared) < 330 * 329 / 2 / 4


def test_stage_links_by_simhash(spark, monkeypatch):
    """Every compared pair has a key of SimHash in common; links are those of brute force, also in a large group."""
    r = random.Random(31)
    base, texts = words(120, 90).split(), [words(r.choice((7, 25, 90)), 3000 + i) for i in range(40)]
    texts += [t.rsplit(" ", 1)[0] for t in texts[::2]]
    for i in range(150):
        w = list(base)
        for at in r.sample(range(120), i % 6):
            w[at] = f"new{r.randrange(10**6)}"
        texts.append(" ".join(w))
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)), strict=False)) for t in texts]
    group = list(range(len(texts)))
    near = [(i, j) for i in range(len(texts)) for j in range(i) if 9 * len(sets[i] & sets[j]) >= 4 * (len(sets[i]) + len(sets[j]))]
    for _ in texts:
        for i, j in near:
            group[i] = group[j] = min(group[i], group[j])
    compared, real = [], near_simhash._alike
    monkeypatch.setattr(near_simhash, "_alike", lambda rows, pairs: [compared.append(pairs.join(rows.toDF("a", "_", "x"), "a").join(rows.toDF("b", "_", "y"), "b").select("x", "y").collect()), real(rows, pairs)][1])
    kept = near_simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted(set(group))
    pairs = [(x["x"], x["y"]) for y in compared for x in y]
    assert len(pairs) < len(texts) * (len(texts) - 1) / 2 / 4
    keys = {t: set(near_simhash._keys(s)[1].tolist()) for t, s in zip(texts, near_simhash.shingle_sets(pa.array(texts)), strict=True)}
    assert all(keys[x] & keys[y] for x, y in pairs)


def test_simhash_keys_find_pairs_at_the_threshold():
    r = np.random.default_rng(4)
    met = []
    for n in (5, 10, 40, 120, 300):
        for _ in range(60):
            s = r.integers(0, 1 << 63, n).astype(np.uint64)
            (_, a), (_, b) = near_simhash._keys(s), near_simhash._keys(s[: n - n // 5])
            met.append(bool(set(a.tolist()) & set(b.tolist())))
    assert sum(met) / len(met) > 0.98


def test_texts_that_meet_by_chance_end_at_their_bucket(spark, monkeypatch):
    texts = [words(60, 900 + i) for i in range(50)]
    texts += [f"{t} more" for t in texts[:6]]
    nodes, tables = [], 5
    for i, s in enumerate(near_simhash.shingle_sets(pa.array(texts))):
        own = near_simhash._keys(s)[0].tolist()
        nodes.append((i, len(s), *own[:4], own[4:], [t << near_simhash.WIDTH for t in range(tables)]))
    nodes = spark.createDataFrame(nodes, f"node long, size int, {', '.join(f'f{i} long' for i in range(4))}, more array<long>, keys array<int>")
    rows = spark.createDataFrame(list(enumerate(texts)), "rid long, text string")
    real, kept = near_simhash.written, []
    monkeypatch.setattr(near_simhash, "written", lambda df: [kept.append((x := real(df)).count()), x][1])
    for told in (64, 10):  # buckets of 56 are told at once, or by the joins
        monkeypatch.setattr(near_simhash, "TOLD", told)
        assert sorted(map(tuple, near_simhash.links(rows, nodes).collect())) == [(50 + i, i) for i in range(6)]
    assert kept[0] <= 12 * tables < kept[2]


def test_simhash_plan_has_no_column_a_word(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    seen, real = [], near_simhash.links
    with pytest.MonkeyPatch.context() as m:
        m.setattr(near_simhash, "links", lambda rows, nodes: [seen.append(nodes.columns), real(rows, nodes)][1])
        assert near_simhash.keep_one(docs).count() == 1
    assert len(seen[0]) < 20


# decontamination


def brute_hits(rows, items):
    def w(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    windows = defaultdict(set)
    for i, t in items:
        x = w(t)
        for s in range(max(1, len(x) - 9) if x else 0):
            windows[tuple(x[s : s + 10])].add("" if i is None else str(i))
    out = []
    for doc_id, t, *_ in rows:
        x, hit, met = w(t), set(), set()
        for win, ids in windows.items():
            for s in range(len(x) - len(win) + 1):
                if tuple(x[s : s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    met |= ids
        out.append((doc_id, len(x), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


ITEMS = [(1, words(17, 2)), (2, words(17, 2).upper()), (10, words(60, 1)), (3, "x"), (4, None), (5, "?!"), (None, words(12, 77)), (6, corpus()[0][1][:150]), (6, corpus()[0][1][:150]), (7, "aaaa bb")]


@pytest.mark.parametrize("block", [400_000, 5])
def test_decontamination(spark, docs, empty, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", block)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    assert found(decontamination.decontaminate(docs, items)) == brute_hits(corpus(), ITEMS)
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(not x[-1] for x in brute_hits(corpus(), ITEMS))
    assert not decontamination.decontaminate(docs, items.limit(0)).filter("contaminated").count()
    assert decontamination.decontaminate(empty, items).count() == 0


# packing


@pytest.mark.parametrize("length", [1024, 64])
def test_packing_round_trip(docs, length):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(docs, tokenizer_path(), length).collect()
    ids = Counter()
    for doc_id, text, *_ in corpus():
        own = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        ids.update((doc_id, s, min(length, len(own) - s), zlib.crc32(np.array(own[s : s + length], "<u4").tobytes()), len(own)) for s in range(0, len(own), length))
    assert Counter(tuple(r)[:5] for r in got) == ids
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= length
    total = sum(r["length"] for r in got)
    assert len(sequences) * length <= 1.03 * total + 2 * length  # few documents: not every window can be filled


def test_special_and_odd_texts():
    from tokenizers import Tokenizer

    t, ids = Tokenizer.from_file(tokenizer_path()), packing._ids(tokenizer_path())
    r = random.Random(1)
    texts = ["a<|endoftext|>b", "a  b", "a   b\n\n c \n", " x", "x ", "\x1c a", "don't I'll", "", " ", " a b", "naïve  café 北京 ١٢ ½²", "a\t b\n  c"]
    texts += ["".join(r.choice(" \n\tabé'1!s½北") for _ in range(40)) for _ in range(300)]
    for x in texts:
        assert ids.of(x) == np.array(t.encode(x, add_special_tokens=False).ids, "<u4").tobytes(), repr(x)


def test_minimum_bin_slack():
    r = random.Random(2)
    for _ in range(100):
        counts = {r.randint(1, 40): r.randint(1, 5) for _ in range(r.randint(1, 6))}
        room = r.randint(1, 60)
        reach = {0}
        for x, n in counts.items():
            reach = {s + k * x for s in reach for k in range(n + 1) if s + k * x <= room}
        chosen = packing.fill(counts, room)
        assert sum(x * n for x, n in chosen.items()) == max(reach) and all(n <= counts[x] for x, n in chosen.items())
    used = Counter()
    counts = {x: r.randint(1, 50) for x in range(1, 65)}
    for size, rank, _, n, _ in (lines := packing.plan(counts, 64)):
        used[size] = max(used[size], rank + n)
    assert all(used[x] <= n for x, n in counts.items()) and lines


def test_packing_empty(empty):
    assert packing.pack(empty, tokenizer_path()).count() == 0


# models


def brute_ppm(training, text, order=ppm.ORDER):
    """Prediction by partial matching, byte by byte."""
    trie = defaultdict(Counter)
    for x in training:
        y = b"\xff" * order + x.lower() + b"\xff"
        for p in range(order, len(y)):
            for k in range(order + 1):
                trie[y[p - k : p]][y[p]] += 1
    y, out = b"\xff" * order + text.lower() + b"\xff", 0.0
    for p in range(order, len(y)):
        gone = set()
        for k in range(order, -1, -1):
            left = {b: n for b, n in trie.get(y[p - k : p], {}).items() if b not in gone}
            if not left:
                continue
            bottom = sum(left.values()) + len(left)
            if y[p] in left:
                out += np.log10(left[y[p]] / bottom)
                break
            out += np.log10(len(left) / bottom)
            gone |= set(left)
        else:
            out -= np.log10(max(1, 256 - len(gone)))
    return out


def test_ppm_is_brute_force(spark):
    r = random.Random(1)
    vocabulary = ["".join(r.choice("abcdeéß") for _ in range(r.randint(1, 5))) for _ in range(30)]
    rows = [(i, " ".join(r.choice(vocabulary) if r.random() < 0.9 else "".join(r.choice("xyzabc") for _ in range(3)) for _ in range(r.randint(0, 40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "A" * 50), (103, "ZZZ0"), (None, "abc"), (7, rows[7][1])]
    crc = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 for i, _ in rows]
    training = [(t or "").encode() for (_, t), c in zip(rows, crc, strict=True) if c != 2]
    got = ppm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = sorted((str(i), brute_ppm(training, (t or "").encode())) for i, t in rows)
    got = sorted((str(x["doc_id"]), x["score"]) for x in got)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], rtol=1e-6, atol=1e-6)  # single precision a byte
    only_held_out = spark.createDataFrame([(i, "ab") for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2], "doc_id long, text string")
    assert {(x["train_tokens"], round(x["score"], 6)) for x in ppm.score_texts(only_held_out).collect()} == {(0, round(-3 * float(np.float32(np.log10(256))), 6))}


def test_ppm_sums_to_one(spark):
    codes, begins = ppm.grams([b"abracadabra", b"abcabc", b"", "straße".encode(), b"ABBA" * 20])
    assert begins.tolist() == [0, 12, 19, 20, 28] and len(codes) == 28 + 81
    known = Counter(codes.tolist())
    for before in (b"abra", b"\xff\xff\xff\xff", b"zzzz", b"xxab", b"\xff\xffst"):
        base = int.from_bytes(before[-1:] * (ppm.ORDER - len(before)) + before, "big") << 8
        asked = spark.createDataFrame([*known.items(), *((base | i, 0) for i in range(256) if base | i not in known)], "s long, n long")
        p = [10 ** x["log"] for x in ppm.probabilities(asked).filter(f"s between {base} and {base | 255}").collect()]
        assert len(p) == 256 and abs(sum(p) - 1) < 1e-9


def test_ppm_names_words_as_split_does():
    raw = [b"", b" a\tB  a\x0b\x0c\r\n", b"\x1c \x85\xa0 a\x00 a", b"x" * 63, b"x" * 64, b"x" * 65, b"y" * 200 + b" " + b"Y" * 200, b"   ", "ab\u2003abcdefgh abcdefghi ABCDEFGH".encode()]
    raw += [w.encode() for w in words(300, 5).split()] + [b"no end " * 40]
    names, sizes = ppm._names(raw)
    own = [w for x in raw for w in x.lower().split()]
    assert sizes.tolist() == [len(x.split()) for x in raw]
    assert len(names) == len(own) and len(set(names.tolist())) == len(set(own)) == len(set(zip(own, names.tolist(), strict=True)))
    assert (names.view(np.int64) < 0).all() and ppm._END_WORD not in names


def test_ppm_strings_are_counted_at_any_size(monkeypatch):
    import pyarrow as pa

    r = random.Random(2)
    raw = ["".join(r.choice("ab é") for _ in range(r.choice((0, 5, 3000)))) for _ in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([i % 3 == 0 for i in range(60)]), pa.array(raw)], ["held_out", "text"])
    want = Counter(ppm.grams([x.encode() for i, x in enumerate(raw) if i % 3])[0].tolist())
    for chunk, piece, held in ((ppm.CHUNK, ppm.PIECE, ppm.HELD), (4000, 700, 10)):
        for k, v in (("CHUNK", chunk), ("PIECE", piece), ("HELD", held)):
            monkeypatch.setattr(ppm, k, v)
        got = Counter()
        for out in ppm._counted(iter([batch.slice(0, 25), batch.slice(25)])):
            got.update(dict(zip(out.column("s").to_pylist(), out.column("n").to_pylist(), strict=True)))
        assert +got == want and set(got) == set(ppm.grams([x.encode() for x in raw])[0].tolist())


def test_ppm_scores_more_unknown_words_than_known_ones():
    import pyarrow as pa

    known, logs = [b"abc", b"d"], {}
    raw = [("abc " + " ".join(f"w{k}n{i}" for k in range(60000)) + " d").encode() for i in range(5)] + [b"", b"d abc x"]
    for code in ppm.grams(raw)[0].tolist():
        logs.setdefault(code, -1 - (code % 7) / 8)
    names = [*ppm._names([b" ".join(known)])[0].tolist(), int(ppm._END_WORD)]
    keys = pa.array(np.array([*names, *logs], np.uint64).view(np.int64))
    answers = pa.table({"key": keys, "n": pa.array([3, 5, 7] + [None] * len(logs), pa.int64()), "log": pa.array([None] * 3 + [*logs.values()], pa.float32())})
    docs = pa.table({"doc_id": pa.array(range(len(raw))), "held_out": pa.array([True] * len(raw)), "text": pa.array([x.decode() for x in raw])})
    got = ppm._scored(docs, answers).to_pylist()
    assert [(x["n_tokens"], x["n_known"]) for x in got] == [(60003, 3)] * 5 + [(1, 1), (4, 3)]
    by_name = dict(zip(names, (3, 5, 7), strict=True))
    assert [round(x["known"], 9) for x in got] == [round(float(sum(np.log10(by_name[int(n)] + 1) for n in ns)), 9) for ns in [[*names]] * 5 + [[names[2]], [*names]]]
    assert np.allclose([x["score"] for x in got], [sum(logs[c] for c in ppm.grams([x])[0].tolist()) for x in raw], rtol=1e-6)


def test_lm_base(docs, empty):
    rows = corpus()
    held = [zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 7 == 2 for r in rows]
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")), None] for r in rows]
    c = Counter(x for t, h in zip(tokens, held, strict=True) if not h for x in t)
    n = sum(c.values())
    want = sorted(((r[0], h, len(t), sum(x in c for x in t), n, round(sum(np.log10((c[x] + 1) / (n + len(c) + 1)) for x in t), 6)) for r, t, h in zip(rows, tokens, held, strict=True)), key=repr)
    got = ppm.score_texts(docs).collect()
    assert sorted(((*tuple(r)[:5], round(float(r["base_score"]), 6)) for r in got), key=repr) == want
    assert all(r["score"] < 0 for r in got)
    assert ppm.score_texts(empty).count() == 0


def test_language(spark, empty):
    r = random.Random(1)
    say = {"en": "the of and to in that is was for it".split(), "fr": "le la les des et que une dans pour au".split()}
    rows = [(i, " ".join(r.choice(say[k]) for _ in range(40)), k) for i in range(400) for k in [r.choice(("en", "fr"))]]
    odd = [(1000, None, "en"), (1001, "", None), (1002, "12 34", "fr"), (None, "the and of the", None), (1003, "the and of it is that was", None)]
    got = language_id.predict_languages(spark.createDataFrame(rows + odd, "doc_id long, text string, lang string")).collect()
    truth = {i: k for i, _, k in rows}
    held = [x for x in got if x["held_out"] and x["doc_id"] in truth]
    assert sum(x["lang_pred"] == truth[x["doc_id"]] for x in held) >= 0.97 * len(held) > 0
    assert {x["doc_id"]: x["lang_pred"] for x in got if x["doc_id"] in (1000, 1001, 1002)} == dict.fromkeys((1000, 1001, 1002), "und")
    assert all(0 <= x["score"] <= 1 for x in got) and len(got) == len(rows) + len(odd)
    assert language_id.predict_languages(empty).count() == 0


def test_states_are_the_trained_ones():
    r = np.random.default_rng(3)
    p = {"w": r.standard_normal((256, 9)).astype(np.float32), "u": r.standard_normal((3, 9)).astype(np.float32)}
    x = r.integers(0, 256, (50, 6)).astype(np.uint8)
    assert np.allclose(language_id.Model._states(p, x), language_id._forward(p, x)[0], atol=1e-5)


def test_documents_are_labelled_by_position(monkeypatch):
    r = np.random.default_rng(4)
    side = lambda: {"w": r.standard_normal((256, 9)).astype(np.float32), "u": r.standard_normal((3, 9)).astype(np.float32)}
    m = language_id.Model(["a", "b"], side(), side(), r.standard_normal((6, 2)).astype(np.float32), np.zeros(2, np.float32))
    monkeypatch.setattr(language_id, "WINDOW", 10)
    monkeypatch.setattr(language_id, "MARGIN", 4)
    lengths = [0, 1, 9, 10, 11, 14, 25, 0, 100]
    data = r.integers(0, 256, sum(lengths)).astype(np.uint8)
    begins = np.concatenate(([0], np.cumsum(lengths)))
    for together in (1024, 3):
        monkeypatch.setattr(language_id, "TOGETHER", together)
        got = m.documents(data, begins)
        for i, n in enumerate(lengths):
            text, want = data[begins[i] : begins[i + 1]], np.zeros(2)
            for s in range(0, n, 10):
                low, high = max(0, s - 4), min(n, s + 14)
                want += m.positions(text[low:high, None])[s - low : min(s + 10, n) - low, 0].sum(0)
            assert np.allclose(got[i], want / max(1, n), atol=1e-5)


def test_gradients():
    r = np.random.default_rng(0)
    p = {"w": r.standard_normal((256, 9)).astype(np.float32), "u": r.standard_normal((3, 9)).astype(np.float32)}
    x, up = r.integers(0, 256, (5, 4)).astype(np.uint8), r.standard_normal((5, 4, 3)).astype(np.float32)
    g = language_id._backward(p, x, language_id._forward(p, x)[1], up)
    for name, at in (("u", (1, 4)), ("u", (2, 8)), ("u", (0, 0)), ("w", (x[2, 1], 5)), ("w", (x[0, 0], 7))):
        moved = []
        for step in (1e-2, -1e-2):
            q = {k: v.astype(np.float64) for k, v in p.items()}
            q[name][at] += step
            moved.append((language_id._forward(q, x)[0] * up).sum())
        assert abs((moved[0] - moved[1]) / 2e-2 - g[name][at]) < 2e-2 * max(1, abs(g[name][at]))


def test_quality_model(spark, empty):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(("good", "fine", "clear")) + str(r.randint(0, 9)) + ("!!" if i % 3 == 0 else "") for _ in range(30))) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0)) for i in range(300)] + [(5, None), (9999, 1)], "doc_id long, quality int")
    docs = spark.createDataFrame([*rows, (None, "good1"), (700, None), (701, "")], "doc_id long, text string")
    got = quality_model.score_quality(docs, labels).collect()
    held = [x for x in got if x["held_out"] and x["doc_id"] is not None and x["doc_id"] < 300]
    assert sum(x["predicted"] == (x["doc_id"] % 3 != 0) for x in held) >= 0.97 * len(held) > 0
    assert len(got) == 303 and all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.7) for x in got)
    assert quality_model.score_quality(docs, labels.limit(0)).count() == 303
    assert quality_model.score_quality(empty, labels).count() == 0
    assert quality_model.keep_good(docs, labels).columns == docs.columns


# rules, licenses, chats


def test_language_pieces_come_from_whole_texts(spark):
    pieces_, piece = language_id.PIECES, language_id.PIECE
    long = "".join(chr(0x100 + i) * piece for i in range(10 * pieces_))
    df = spark.createDataFrame([(1, long), (2, long[: pieces_ * piece]), (3, "é"), (4, ""), (5, None)], "doc_id long, text string")
    got = {r[0]: r[1] for r in df.select("doc_id", language_id.sampled(F.col("text"), F.col("doc_id"))).collect()}
    assert got[2] == long[: pieces_ * piece] and got[3] == "é" and got[4] == "" and got[5] is None
    drawn = got[1].split("\n")
    assert len(drawn) == pieces_ and all(len(x) == piece and x in long for x in drawn)
    places = [long.index(x) / len(long) for x in drawn]
    assert places == sorted(places) and places[0] < 0.1 and places[-1] > 0.9


def test_quality_rules(docs, empty):
    got = quality_rules.quality_rules(docs).collect()
    want = []
    for doc_id, t, *_ in corpus():
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + j for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if windows[x] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered), failed))
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(want, key=repr)
    assert not any(r["kept"] and r["base_failed"] for r in got)
    assert quality_rules.quality_rules(empty).count() == 0


def test_licenses(spark, empty):
    mit, bsd2, bsd3 = (license_texts.TEXTS[k][0] for k in ("MIT", "BSD-2-Clause", "BSD-3-Clause"))
    wrapped = "\n".join(re.findall(r"(.{1,77})(?:\s|$)", mit.replace("\n", " ")))
    prose = words(50, 4)
    texts = [
        ("x y z\nReleased under the MIT License.\ny z", "MIT"),
        (f"{prose}\nLicensed under the\nApache License, Version 2.0\n{prose}", "Apache-2.0"),
        (f"Copyright 2020 A. Author\n\n{wrapped}\n\n{prose}", "MIT"),
        (f"{prose} {mit.upper()} {prose} {mit.replace('Software', 'Program')}", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0"),
        ("This work is licensed under the GNU General Public License, version 2", "GPL-2.0"),
        ("This work is licensed under the GNU General Public License", ""),
        ("This work is licensed under a Creative Commons Attribution 4.0 International License!", "CC-BY-4.0"),
        ("this work is licensed under a creative commons attribution-noncommercial 4.0 international license", "CC-BY-NC-4.0"),
        (bsd2, "BSD-2-Clause"),
        (bsd3, "BSD-3-Clause"),
        (f"{bsd3}\n{mit}\nLicensed under CC BY 4.0", "BSD-3-Clause,CC-BY-4.0,MIT"),
        ("mit license", ""),
        (None, ""),
        ("", ""),
        ("\n\n", ""),
        ("word " * 30000, ""),
        (f"{prose} " * 3000 + mit, "MIT"),
    ]
    df = spark.createDataFrame([(i, t, 1) for i, (t, _) in enumerate(texts)] + [(0, texts[0][0], 1)], "doc_id long, text string, pairs int")
    got = [tuple(r) for r in licenses.scan_licenses(df).orderBy("doc_id").collect()]
    assert got[0] == got[1] == (0, 10, 1, "MIT", 1.0)
    assert [x[3] for x in got[1:]] == [x for _, x in texts]
    assert [x[2] for x in got[1:6]] == [1, 1, 1, 2, 1] and got[12][2] == 3
    assert all((x[2] == 0) == (x[4] == 0) for x in got)
    own = licenses.scan_licenses(df, {"Own": ["free to read and to print"]})
    assert own.filter("n_matches > 0").count() == 0
    assert licenses.scan_licenses(empty).count() == 0


def test_license_versions(spark):
    """Every version has its own name in the same phrasing; one that isn't known has none, and not its neighbour's."""
    prose = words(30, 8)
    texts = [
        ("Licensed under the GNU Lesser General Public License, version 2.1", "LGPL-2.1"),
        ("Licensed under the GNU Lesser General Public License, version 3", "LGPL-3.0"),
        ("Licensed under the GNU General Public License, version 2", "GPL-2.0"),
        ("Licensed under the GNU General Public License, version 1", "GPL-1.0"),
        ("Licensed under the GNU General Public License, version 7", ""),
        ("Licensed under the GNU Lesser General Public License, version 4", ""),
        ("Licensed under the Apache License, Version 3.5", ""),
        ("Licensed under the Apache License, Version 1.1", "Apache-1.1"),
        ("Licensed under the Mozilla Public License 1.1", "MPL-1.1"),
        ("Licensed under CC BY-SA 3.0", "CC-BY-SA-3.0"),
        ("Licensed under CC BY-SA 9.0", ""),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License.", "CC-BY-SA-3.0"),
        ("GPL v3.0 or later", "GPL-3.0"),
        ("// SPDX-License-Identifier: MIT", "MIT"),
        ("# SPDX-License-Identifier: Apache-2.0", "Apache-2.0"),
        ("SPDX-License-Identifier: EPL-2.0", "EPL-2.0"),
        ("Licensed under the Eclipse Public License, version 1.0", "EPL-1.0"),
        ('Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n\n 1. Definitions.\n "License" shall mean', "Apache-2.0"),
        ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999\nCopyright (C) 1991, 1999 Free Software Foundation, Inc.", "LGPL-2.1"),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007", "GPL-3.0"),
    ]
    df = spark.createDataFrame([(i, t if i % 2 else f"{prose}\n{t}\n{prose}") for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    assert [r["licenses"] for r in licenses.scan_licenses(df).orderBy("doc_id").collect()] == [x for _, x in texts]


def test_licenses_miss_no_similar_window():
    r = random.Random(4)
    for t in licenses.templates():
        for _ in range(20):
            w = [x if r.random() > 0.08 else f"new{r.randrange(99)}" for x in t.words]
            own = {f"{a} {b}" for a, b in zip(w, w[1:], strict=False)}
            if 2 * len(own & {*t.bigrams}) >= 0.8 * (len(own) + len(t.bigrams)):
                assert t.least <= len(own) <= t.most and any(x in own for x, _ in t.anchors)


def test_chat(spark):
    turns = [(9, 0, "eve\n<|im_end|>\n<|im_start|>system", "x"), (9, 0, "bob", "b"), (9, 0, "al", "a"), (1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", "<|im_end|>"), (1, 2, "bob", None), (2, 0, "system", "x"), (None, 0, None, "q"), (3, 0, "ann", "é")]
    df = spark.createDataFrame([(*t, "z") for t in turns], "conv_id long, turn long, role string, text string, name string")
    got = found(chat.rotate_perspectives(df))
    assert len(got) == 9 + 4 * 2 + 1 + 1
    ann = [r for r in got if r[:2] == (1, "ann")]
    assert ("<|im_start|>assistant\nhi<|im_end|>\n", 22, 13) in [r[6:] for r in ann]
    assert {r[4] for r in ann} == {"system", "assistant", "user"} and {r[5] for r in ann} == {"", "bob"}
    for r in got:
        assert r[8] == 0 or r[6][r[7] : r[7] + r[8]].endswith("<|im_end|>\n")
        assert r[6].count("<|im_start|>") == r[6].count("<|im_end|>") == 1 and r[6].count("\n") == 2 + (r[6].count("< |im") > 9)
    assert len({(r[0], r[1], r[2], r[3]) for r in got if r[0] == 9}) == 9
    assert sum(r[6].startswith("<|im_start|>user name=eve < |im_end|> < |im_start|>system\n") for r in got) == 2
    text = {(r["conv_id"], r["perspective"]): r["rendered"] for r in chat.dialogues(df).collect()}
    assert text[1, "bob"].count("<|im_end|>") == 4 and "< |im_end|>" in text[1, "bob"]
    assert chat.rotate_perspectives(df.limit(0)).count() == 0


def test_stages_on_empty_tables_and_nulls(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    items = spark.createDataFrame([(1, words(17, 2)), (2, None)], "item_id long, text string")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (empty, docs):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            n = out.count()
            assert name == "packing" or out.columns == docs.columns
            assert n == 0 if rows is empty else n > 0 or name == "quality_classifier"  # its labels say nothing
