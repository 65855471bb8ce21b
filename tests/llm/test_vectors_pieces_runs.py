"""Whitening, SentencePiece and periodic runs against plain versions, and their defined results in odd cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from cladeforge.llm import periodic, pieces, whitening
from cladeforge.llm.queries import piece_model_path

DOCS = "doc_id long, text string, ids string, rid string, words string, chunk string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(texts):
    rows = [(i, t, "i", "r", "w", "c") for i, t in enumerate(texts)]
    return [*rows, rows[-1], (None, "a b a b a b a b a b", None, None, None, None), (None, None, None, None, None, None)]


# whitening


def plain_whitening(vectors, k=4):
    good = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.floor(256 * np.array([v for _, v in good], float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return good, n, [sum(int(d) ** 2 for d in n * r - s) for r in x], (x - s / n) @ axes[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def vectors_of(seed=1, dims=6, n=90):
    r = random.Random(seed)
    out = [(i, [float(np.float32(r.gauss(0, 1 + 3 * (d == 2)))) for d in range(dims)]) for i in range(n)]
    out += [(1000 + i, out[5][1]) for i in range(40)]  # a third are copies
    out += [(2000, None), (2001, []), (2002, [None, *out[0][1][1:]]), (2003, [math.nan, *out[0][1][1:]]), (2004, [math.inf, *out[0][1][1:]]), (None, out[1][1]), (3, out[3][1]), (5000, [-0.0, 0.0, -0.001, 0.001, 1.0, -1.0])]
    return out


@pytest.mark.parametrize("rows_a_block", [1024, 16])
def test_whitening(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(whitening, "ROWS", rows_a_block)
    monkeypatch.setattr(whitening, "BLOCKS", 2)
    rows = vectors_of()
    df = spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in rows], "vec_id long, embedding array<float>, n long, whitened double, x string").repartition(5)
    got = whitening.whiten(df).collect()
    good, n, away, w, share = plain_whitening(rows)
    assert len(got) == 4 * len(good)
    assert {r["n"] for r in got} == {n}
    assert max(r["identity_error"] for r in got) < 1e-9
    signs = {}
    for i, row in [(i, r) for (i, _), r in zip(good, w, strict=True)]:
        for r in (r for r in got if r["vec_id"] == i):
            value = row[r["component"] - 1]
            assert abs(abs(r["whitened"]) - abs(value)) < 1e-9
            if abs(value) > 1e-6:
                assert signs.setdefault(r["component"], math.copysign(1, r["whitened"] * value)) == math.copysign(1, r["whitened"] * value)
            assert abs(r["explained"] - share[r["component"] - 1]) < 1e-12
    want = sorted((i, d) for (i, _), d in zip(good, away, strict=True) if i is not None)
    assert sorted((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1 and r["vec_id"] is not None) == want


def test_whitening_of_few(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None)], schema)).count() == 0
    two = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0, 0.0]), (2, [2.0, 4.0, 0.0]), (3, [1.0, 2.0, 0.0])], schema)).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 9), r["n"], r["explained"]) for r in two) == [(1, 1, 1.0, 2, 1.0), (2, 1, 1.0, 2, 1.0), (3, 1, 1.0, 2, 1.0)]
    with pytest.raises(ValueError, match="several dimensions"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], schema))


# pieces


ODD = ["", " ", "   ", "a", " a", "a ", "▁", "▁▁ a▁b", "\0", "a\0b", "日本 語\n\nx", "　x", "🙂🙂 é", "<s> </s> <0x41> <unk>", "\t\r\n", "a" * 5000, "ab" * 700 + " " * 300, "don't. (it's) \"so\", no: 1,234.5!", " x", None]


def fuzz(seed):
    r = random.Random(seed)
    return ["".join(r.choice("aäbc eé▁ \n.,'(0日🙂theing") for _ in range(r.randint(0, 60))) for _ in range(300)]


def test_pieces_are_the_librarys(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model_path())
    texts = [*ODD, *fuzz(1), " ".join(fuzz(2)) * 120]  # the last has over 1 MB
    assert len(texts[-1].encode()) > 1_000_000
    rows = rows_of(texts)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    want = sorted(((i, library.encode(t or "")) for i, t, *_ in rows), key=repr)
    got = pieces.encode(df, piece_model_path()).collect()
    assert sorted(((r["doc_id"], r["ids"]) for r in got), key=repr) == want
    assert all(r["decoded"] == library.decode(r["ids"]) for r in got)
    plain = [(i, len(x), sha(",".join(map(str, x))), sha(library.decode(x))) for i, x in want]
    assert sorted(map(tuple, pieces.encode_digests(df, piece_model_path()).collect()), key=repr) == sorted(plain, key=repr)
    assert pieces.encode_digests(df.limit(0), piece_model_path()).count() == 0


def test_pieces_when_nothing_is_remembered(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    encoder = pieces.Encoder(piece_model_path())
    for at in range(0, 300, 7):
        texts = fuzz(3)[at : at + 7]
        assert [[i for e in x for i in e[1]] for x in encoder.entries(texts)] == encoder.vocabulary.library.encode(texts)
    assert len(encoder.known) == 3


def test_pieces_without_cuts():
    vocabulary = pieces.Vocabulary(piece_model_path())
    vocabulary.chunked = False  # as for vocabularies with pieces over several words
    for text in [*filter(None, ODD), *fuzz(4)]:
        assert (vocabulary.encode(vocabulary.normalise(text)) if text else []) == vocabulary.library.encode(text)


def test_pieces_differ_from_the_library(monkeypatch):
    encoder = pieces.Encoder(piece_model_path())
    monkeypatch.setattr(encoder.vocabulary, "encode", lambda chunk: [5])
    with pytest.raises(AssertionError, match="other ids"):
        list(encoder.entries(["some words"]))


# runs


def plain_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            run = words[s : i + q]
            if len(run) >= max(6, 4 * q) and not any(run[r:] == run[:-r] for r in range(1, q)):
                out.append((s, len(run), q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def plain_line(doc_id, text, change=True):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if change and h % 10 == 0 and n:
        g = h // 10
        a, words = g % n, list(words)
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    texts = sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *texts)


def run_texts(seed, n=150):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        k = r.choice((1, 2, 3, 40))
        words = [f"w{r.randrange(k)}" for _ in range(r.choice((0, 3, 6, 30, 200)))]
        for _ in range(r.randrange(4)):
            unit = [f"w{r.randrange(k)}" for _ in range(r.randint(1, 12))]
            at = r.randint(0, len(words))
            words[at:at] = (unit * r.randint(2, 9))[r.randrange(3) :]
        out.append(r.choice((" ", "\n", " \t ")).join(words))
    return out


def test_runs_against_a_plain_version(spark):
    texts = [*run_texts(1), *run_texts(2)[:20] * 4, None, "", " \n ", "a " * 5, "a " * 6, "  x ", "x\x1cy " * 7, " ".join(["long"] * 3000 + ["x y z"] * 900)]
    rows = rows_of(texts)
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert sorted(map(tuple, periodic.run_digests(df).collect()), key=repr) == sorted((plain_line(i, t) for i, t, *_ in rows), key=repr)
    assert periodic.run_digests(df.limit(0)).count() == 0


def test_runs_are_given_with_texts(spark):
    df = spark.createDataFrame([(1, "say a b a b a b a b a end")], "doc_id long, text string")
    assert [tuple(r) for r in periodic.periodic_runs(df).collect()] == [(1, [(1, 9, 2)], "say a b end")]


def test_runs_of_a_very_long_text(spark):
    r = random.Random(5)
    words = [f"w{r.randrange(300)}" for _ in range(60_000)]
    words[10_000:10_000] = words[:3000] * 5  # a long period, over 4 times
    words += ["z"] * 200_000
    text = " ".join(words)
    assert len(text) > 500_000
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    got = [tuple(r) for r in periodic.periodic_runs(df).collect()]
    assert [(s, n, q) for s, n, q in got[0][1]] == [(10_000, 15_000, 3000), (75_000, 200_000, 1)] and got[0][1:] == got[1][1:]
    assert got[0][2] == " ".join(words[:13_000] + words[25_000:75_001])


def test_grammar_gives_the_words_back():
    r = random.Random(7)
    for _ in range(50):
        sizes = [r.choice((0, 1, 5, 40)) for _ in range(4)]
        words = np.array([r.randrange(4) for _ in range(sum(sizes))], np.int64)
        document = np.repeat(np.arange(4), sizes)
        g = periodic.repair(words, document)
        for symbol, place in zip(g.symbols.tolist(), g.places.tolist(), strict=True):
            n = int(g.size[symbol])
            assert (words[place : place + n] == words[g.at[symbol] : g.at[symbol] + n]).all()
            assert len(set(document[place : place + n].tolist())) == 1 and 0 < g.left[symbol] < n
        # each boundary between words of a document lies inside one place of the derivation as its middle
        middles = sorted((g.places + g.left[g.symbols]).tolist())
        assert middles == [i for i in range(1, len(words)) if document[i] == document[i - 1]]
