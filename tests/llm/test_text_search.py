"""Collocations, ranked search and pieces against brute force, the library and odd inputs."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from nightshare.llm import collocations, flat, lexical, pieces
from nightshare.llm.queries import QUERIES
from nightshare.llm.tokens import tokenizer_path

SMALL = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "A A A A A A", "É ß é", "x" * 5000, "a.b,c;d!e?f\ng", "日本語 のテキスト", "a▁b  ▁ c"]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


# --- flat words -----------------------------------------------------------------------


def test_words_of_slices_and_neighbours():
    column = pa.array(["zz", "ab", None, "Cd e", "", "f.g h"]).slice(1)
    found, row, piece = flat.words(column, collocations.CLASSES)
    assert found.to_pylist() == [b"ab", b"cd", b"e", b"f", b"g", b"h"]
    assert row.tolist() == [0, 2, 2, 4, 4, 4]
    assert [piece[i] == piece[i + 1] for i in range(5)] == [False, True, False, False, True]


def test_chunks_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 50, 0, 3, 3, 3)])], names=["text"])
    parts = list(flat.chunks(batch, "text", 8))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([batch]).to_pydict()
    assert all(len(p) == 1 or sum(map(len, p.column(0).to_pylist())) <= 8 for p in parts)


# --- collocations ---------------------------------------------------------------------


def plain_collocations(rows, least, top, longest=5, drop_percent=100):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", lower(text)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    out = {}
    cands = {key: c for key, c in f.items() if len(key[1]) > 1 and c >= least}
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    for (lang, p), a in cands.items():
        if any(x == lang and len(q) > len(p) and 100 * c >= drop_percent * a and inside(p, q) for (x, q), c in cands.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, v in out.items() for i, (s, a, p, left, right) in enumerate(sorted(v)[:top])}


def as_set(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


def test_collocations_against_brute_force(spark, texts, monkeypatch):
    rows = [(t, lang) for _, t, lang in texts[:60]] + [(t, None) for t in ODD] + [("the the the the the", "und"), ("Cold rain falls. cold rain falls", "en")] * 3
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    monkeypatch.setattr(collocations, "CHUNK", 4000)
    assert as_set(collocations.collocations(df, 4, 50)) == plain_collocations(rows, 4, 50)


@pytest.mark.parametrize("percent", [50, 80])
def test_subsumption_share(spark, percent):
    rng = random.Random(percent)
    rows = [(" ".join(rng.choice("abcd") for _ in range(12)), "x") for _ in range(40)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert as_set(collocations.collocations(df, 3, 1000, drop_percent=percent)) == plain_collocations(rows, 3, 1000, drop_percent=percent)


def test_collocations_of_nothing_and_of_other_columns(spark):
    empty = spark.createDataFrame([], "text string, lang string, phrase string, n int")
    assert collocations.collocations(empty).collect() == []
    rows = [("p q r", "x", "s", 1)] * 5
    out = collocations.collocations(spark.createDataFrame(rows, "text string, lang string, phrase string, n int"), 5)
    assert as_set(out) == plain_collocations([("p q r", "x")] * 5, 5, 10)


def test_scores_beyond_64_bits(spark):
    levels = [
        spark.createDataFrame([("x", "", 1, 10**14, ["p", "q"], [3 * 10**12, 10**12])], "lang string, prefix string, slice int, total long, next array<string>, n array<long>"),
        spark.createDataFrame([("x", "p", 0, 10**12, ["q"], [10**12])], "lang string, prefix string, slice int, total long, next array<string>, n array<long>"),
    ]
    words = spark.createDataFrame([("x", 10**14)], "lang string, words long")
    (row,) = collocations.rank_phrases(levels, words, 100, 10, 100).collect()
    assert row.score == 1000 * 10**12 * 10**14 // (3 * 10**12 * 10**12)


def test_filter_holds_all_of_its_phrases(spark):
    phrases = [("en", f"w{i} v{i % 7}") for i in range(5000)]
    bits = collocations.bit_filter(spark.createDataFrame(phrases, "lang string, phrase string"), len(phrases))
    hashes = lambda words: collocations.word_hashes(pa.array(words, pa.binary()), collocations._seed("en"))
    asked = collocations.chain([hashes([p.split()[i].encode() for _, p in phrases]) for i in (0, 1)])
    assert collocations._holds(bits, asked).all()
    other = collocations.chain([hashes([f"z{i}".encode() for i in range(5000)]), hashes([b"v"] * 5000)])
    assert collocations._holds(bits, other).mean() < 0.05


# --- ranked search --------------------------------------------------------------------


def plain_search(docs, items, k=10):
    terms = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    if not held:
        return set()
    number, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = set()
    for item, own in asked.items():
        scores = []
        for d, c in held:
            m = 10 + (90 * sum(c.values()) * number) // total
            s = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out |= {(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])}
    return out


def found(df):
    return {(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()}


def test_search_against_brute_force(spark, texts, monkeypatch):
    docs = [(d, t) for d, t, _ in texts] + [(10**6 + i, t) for i, t in enumerate(ODD)] + [(None, "one two"), (None, None), (7, "one"), (7, "one")]
    items = [(i, texts[i * 9][1][:400]) for i in range(15)] + [(99, None), (98, ""), (None, "one two"), (50, "one"), (50, "É ONE zzz"), (51, "nothingofthekind")]
    df, asked = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")
    assert found(lexical.ranked_search(df, asked)) == plain_search(docs, items)
    monkeypatch.setattr(lexical, "PACK", 1500)
    monkeypatch.setattr(lexical, "BLOCK", 8)
    monkeypatch.setattr(lexical, "CELLS", 1)
    monkeypatch.setattr(lexical, "SUMMARY_CELLS", 3000)
    assert found(lexical.ranked_search(df, asked, 4)) == plain_search(docs, items, 4)


def test_search_of_nothing_and_of_other_columns(spark):
    docs = spark.createDataFrame([(1, "one", 5), (2, "two one", 6)], "doc_id long, text string, score int")
    items = spark.createDataFrame([(3, "one", 1)], "item_id long, text string, rank int")
    assert found(lexical.ranked_search(docs, items)) == plain_search([(1, "one"), (2, "two one")], [(3, "one")])
    assert lexical.ranked_search(docs.limit(0), items).collect() == [] == lexical.ranked_search(docs, items.limit(0)).collect()


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(3)
    weights = np.zeros((1024, 90), np.int64)
    group = np.arange(1024) % 30
    for t in range(3):
        weights[np.arange(1024), group * 3 + t] = rng.integers(5 * 10**8, 10**9, 1024)
    weights[rng.random(weights.shape) < 0.05] = 1000
    shard = lexical.Shard(weights)
    terms = np.array([0, 1, 2, 40, 80])
    assert all(shard.bounds(np.array([b]), terms)[0] >= weights[np.ix_(m, terms)].sum(axis=1).max() for b, m in enumerate(shard.members))
    for t in range(90):
        assert sorted(np.concatenate(shard.members[shard.first[t] : shard.first[t + 1]]).tolist()) == np.flatnonzero(weights[:, t]).tolist()
    best = shard.search(terms, (np.zeros(0, np.int64), np.zeros(0, np.int64)), np.arange(1024), 10)
    scores = weights[:, terms].sum(axis=1)
    assert best[0].tolist() == sorted(scores.tolist())[:-11:-1]
    at = np.concatenate([np.arange(shard.first[t], shard.first[t + 1]) for t in terms])
    assert (shard.bounds(at, terms) < best[0][-1]).mean() > 0.3


# --- pieces ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(pieces.PIECE_BPE))


def test_pieces_against_the_library(spark, texts, library):
    rows = [(d, t) for d, t, _ in texts] + [(-i, t) for i, t in enumerate(ODD)]
    out = pieces.encode(spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, ids string"), decoded="back")
    for r in out.collect():
        want = library.encode(r.text or "") + [2]
        assert r.ids == want and r.back == library.decode(want)
    again = pieces.decode(out).collect()
    assert all(r.decoded == r.back for r in again)


def test_digests(spark, library):
    df = spark.createDataFrame([(1, "Some words, and more.", 3), (1, "Some words, and more.", 3), (None, None, None)], "doc_id long, text string, n_tokens int")
    for r in pieces.piece_digests(df).collect():
        ids = library.encode("Some words, and more." if r.doc_id else "") + [2]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    assert pieces.piece_digests(df.limit(0)).collect() == []


def test_random_texts_and_long_words(library):
    vocabulary = pieces.Pieces(tokenizer_path(pieces.PIECE_BPE))
    rng = random.Random(4)
    letters = list("abcdehinorst  ▁\n.,;é日本ー\U0001f600\x00<>0x1234")
    some = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    some += ["".join(rng.choice(kind) for _ in range(rng.randint(0, 900))) for kind in ("abe", "aben ", " ", "▁ x", "日本") for _ in range(30)]
    some += [None, "", "ab" * 40000, " " * 5000, "lorem ipsum " * 90000]
    ids, offsets = vocabulary.encode(pa.array(some, pa.string()))
    for t, a, b in zip(some, offsets, offsets[1:]):
        assert ids[a:b].tolist() == library.encode(t or ""), (t or "")[:60]


def test_decoding_any_ids(library):
    vocabulary = pieces.Pieces(tokenizer_path(pieces.PIECE_BPE))
    rng = random.Random(5)
    rows = [[rng.choice((rng.randrange(32000), rng.randrange(3, 259), 2, 0)) for _ in range(rng.randint(0, 30))] for _ in range(400)]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    assert vocabulary.decode(np.array([i for r in rows for i in r], np.int64), bounds) == [library.decode(r) for r in rows]
    assert vocabulary.decode(np.zeros(0, np.int64), np.array([0, 0])) == [""]


def test_decode_keeps_null_sequences(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [28705, 2])], "k int, ids array<int>")
    assert {r.k: r.decoded for r in pieces.decode(df).collect()} == {1: None, 2: "", 3: ""}


def test_queries_keep_every_document(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert QUERIES["op13_merge_round_pieces"](spark, SMALL).agg(F.count_distinct("doc_id")).first()[0] == docs.count()


# --- ids of whole columns --------------------------------------------------------------


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_of_a_column_equal_the_library(texts, name, monkeypatch):
    from nightshare.llm import tokens

    encoder = tokens.Encoder(tokens.tokenizer_path(name))
    rng = random.Random(6)
    letters = list("abcdehinorst  \n.,;éÀßŒ日本ー\U0001f600\x00<>'0x1234\t×÷")
    some = ["".join(rng.choice(kind) for _ in range(rng.randint(0, 40))) for kind in (letters, "abeéÉ .,1", "ab ", " \n.") for _ in range(500)]
    some += [None, "", " ", "a", " a", "a ", "it's", "<|endoftext|> x", "x" * 3000, "Ab" * 50000, *ODD, *[t for _, t, _ in texts[:40]]]
    for size in (64, 8 << 20):
        monkeypatch.setattr(flat, "CHUNK", size)
        got = list(encoder.encode_all(pa.array(some, pa.string())))
        assert [g.tolist() for g in got] == [encoder.whole(t).tolist() if t else [] for t in some]
    assert list(encoder.encode_all(pa.array([], pa.string()))) == []
