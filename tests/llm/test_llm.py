"""The training-data operators against brute force, exact round trips and odd inputs."""

import itertools
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from nightshare.llm import chaining, graph, licenses, mixing, packing, permutation_search, pivot_search, planes, quality, simhash, tokens, warc
from nightshare.llm.queries import QUERIES, SQL
from nightshare.session import shared_dir
from parity import compare

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, texts, ids=None, source="s"):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "en", source, None if t is None else len(t)) for i, t in zip(ids, texts)], DOCS)


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return [f"w{v}" for v in rng.integers(0, 10**9, n)]


ODD = [None, "", " \n\t ", "one", "One two", "a b c d", "a b c d", "x" * 3000, " ".join(prose(30000, 1)), "ÄÖ é ß", "mit license MIT LICENSE cc by"]


@pytest.fixture(scope="module")
def small_docs(spark):
    return [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    status, _, _, note = compare(spark, SMALL, name, QUERIES[name], SQL[name])
    assert status == "ok", note


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


# --- simhash -----------------------------------------------------------------------------


def plain_fingerprint(text, k=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints):
    """prints: [(id, fingerprint)] -> smallest reachable id per position, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i][1] ^ prints[j][1]).bit_count() <= 2:
            root[find(j)] = find(i)
    low = {}
    for i, (d, _) in enumerate(prints):
        low[find(i)] = min(low.get(find(i), d), d)
    return [low[find(i)] for i in range(len(prints))]


def test_simhash_against_all_pairs(spark, small_docs):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_bit_sliced_simhash"](spark, SMALL).collect()}
    prints = [(d["doc_id"], plain_fingerprint(d["text"])) for d in small_docs]
    want = plain_components(prints)
    assert got == {d: (f"{p:016x}", c) for (d, p), c in zip(prints, want)}


def test_bit_sliced_links_against_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = np.concatenate([base[i % 12 : i % 12 + 1] ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 5), replace=False))) for i in range(300)])
    group = np.sort(rng.integers(0, 4, 300))
    root = simhash.spanning_links(values.astype(">u8").view(np.uint8).reshape(-1, 8), group, 2, lanes=64)
    label = list(range(300))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.combinations(range(300), 2):
            if group[i] == group[j] and int(values[i] ^ values[j]).bit_count() <= 2 and label[i] != label[j]:
                label[i] = label[j] = min(label[i], label[j])
                changed = True
    assert root.tolist() == label


@pytest.mark.parametrize("radius", [0, 1, 3, 7, 40])
def test_carry_save_counters(radius):
    rng = np.random.default_rng(radius)
    values = rng.integers(0, 256, (50, 8), dtype=np.uint8)
    values[10:20] = values[9] ^ (rng.random((10, 8)) < 0.2).astype(np.uint8)
    planes_ = simhash.bit_planes(values)
    ints = [int.from_bytes(v.tobytes(), "big") for v in values]
    for shift in (1, 2, 9):
        live = simhash.within(planes_, shift, (1 << (50 - shift)) - 1, radius)
        assert [bool(live >> i & 1) for i in range(50 - shift)] == [(ints[i] ^ ints[i + shift]).bit_count() <= radius for i in range(50 - shift)]


def test_large_buckets_are_tiled_whole(spark):
    rows = [(7, struct.pack(">Q", (1 << i) - 1), i) for i in range(65)] + [(8, struct.pack(">Q", 0), 900)]
    links = simhash.bucket_links(spark.createDataFrame(rows, "bucket long, value binary, node long"), 1, tile=5)
    roots = {r.node: r.root for r in graph.components(links).collect()}
    assert roots == {i: 0 for i in range(65)}


def test_simhash_odd_rows(spark):
    rows = docs_of(spark, ODD).withColumn("component_id", F.lit(1)).withColumn("fingerprint", F.lit("x"))
    got = sorted((r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_components(rows).collect())
    prints = [(i, plain_fingerprint(t)) for i, t in enumerate(ODD)]
    assert got == [(i, f"{p:016x}", c) for (i, p), c in zip(prints, plain_components(prints))]
    again = simhash.simhash_components(docs_of(spark, ["a b c", "a b c", "q"], [4, 4, None])).collect()
    assert Counter((r.doc_id, r.component_id) for r in again) == {(4, 4): 2, (None, None): 1}
    assert simhash.simhash_components(docs_of(spark, [])).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (50, 50), (200, 100)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 100}


def jaccard(a, b, k=5):
    s, t = ({tuple(x.lower().split()[i : i + k]) for i in range(len(x.split()) - k + 1)} for x in (a, b))
    return len(s & t) / len(s | t)


def test_near_copies(spark):
    base = prose(400, 3)
    near = [*base[:150], "new", *base[151:300], "other", *base[301:]]
    far = [w if i % 6 else f"e{i}" for i, w in enumerate(base)]
    texts = [" ".join(base), " ".join(near), " ".join(far), " ".join(prose(400, 4)), " ".join(base)]
    assert jaccard(texts[0], texts[1]) >= 0.8 > 0.3 > jaccard(texts[0], texts[2])
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs_of(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 0}


def test_near_copies_are_checked_by_exact_similarity(spark):
    line = prose(12, 60)
    lone = [" ".join([*line * 60, *prose(150, 61 + i)]) for i in range(12)]
    base = prose(200, 90)
    line_twice, line_often = (" ".join([*base, *line * n]) for n in (2, 60))
    assert jaccard(line_twice, line_often) == 1.0 and max(jaccard(a, b) for a, b in itertools.combinations(lone, 2)) < 0.2
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs_of(spark, [*lone, line_twice, line_often])).collect()}
    assert got == {**{i: i for i in range(12)}, 12: 12, 13: 12}


def test_near_copies_at_the_bound(spark):
    texts, want = [], {}
    for n in range(120):
        base = prose(140, 5000 + n)
        edits = 3 if n % 2 else 4
        other = [f"e{i}" if i % 30 == 20 and i < 30 * edits else w for i, w in enumerate(base)]
        want |= {len(texts): len(texts), len(texts) + 1: len(texts) + (edits > 3)}
        texts += [" ".join(base), " ".join(other)]
        assert (0.8 <= jaccard(*texts[-2:]) < 0.81) if edits == 3 else (0.72 < jaccard(*texts[-2:]) < 0.8)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs_of(spark, texts)).collect()}
    assert got == want


def test_exact_links_against_sets():
    rng = np.random.default_rng(11)
    base = rng.integers(-(2**62), 2**62, (6, 60))
    sets = [np.unique(np.where(rng.random(60) < 0.08, rng.integers(-(2**62), 2**62, 60), base[i % 6])) for i in range(50)] + [np.zeros(0, np.int64)] * 2
    want = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b))}
    assert set(zip(*(x.tolist() for x in simhash.exact_links(sets, sets, 0.8)))) == want and len(want) > 100


@pytest.mark.parametrize("part", [7, 64])
def test_groups_of_any_size_connect_as_all_pairs_do(spark, part):
    """One group of chains, stars and loners cut into slices: the classes of all its pairs, whatever the slices."""
    rng = np.random.default_rng(part)
    sets, text = [], rng.integers(0, 10**9, 80)
    for i in range(150):
        if i % 30 == 0:
            text = np.concatenate([text[:40], rng.integers(0, 10**9, 40)])
        elif i % 3:
            text = np.concatenate([text[: 80 - int(rng.integers(3, 9))], rng.integers(0, 10**9, 9)])[:80]
        sets.append(np.unique(np.concatenate([text, rng.integers(0, 10**9, int(rng.integers(0, 12)))])))
    label = list(range(150))
    for i, j in itertools.combinations(range(150), 2):
        if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j])):
            x, y = label[i], label[j]
            label = [min(x, y) if v in (x, y) else v for v in label]
    assert 5 < len(set(label)) < 120
    frame = spark.createDataFrame([(7, i, x.tolist()) for i, x in enumerate(sets)], "group bigint, node bigint, shingles array<bigint>")
    got = {r.node: r.root for r in graph.components(simhash.checked_links(frame, 0.8, part, 3)).collect()}
    assert [got.get(i, i) for i in range(150)] == label


def test_near_copies_against_brute_force(spark):
    """2000 texts, 400 pairs of them planted at a similarity of 0.76 to 0.87, beside a line that every text holds."""
    rng, line = np.random.default_rng(21), prose(12, 5)
    texts = []
    for i in range(400):
        words = prose(150, 1000 + i)
        other = list(words)
        for at in np.linspace(4, 140, 2 + i % 3).astype(int):
            other[at] = f"x{i}"
        texts += [" ".join(words), " ".join(other)]
    texts += [" ".join(prose(int(rng.integers(5, 80)), 9000 + i) + line) for i in range(1200)]
    grams = [frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in (t.split() for t in texts)]
    held = defaultdict(set)
    for i, g in enumerate(grams):
        for x in g:
            held[x].add(i)
    label = list(range(2000))
    pairs = {(i, j) for x in held.values() if len(x) < 50 for i, j in itertools.combinations(sorted(x), 2)}
    links = [(i, j) for i, j in pairs if len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j])]
    for i, j in links:
        x, y = label[i], label[j]
        label = [min(x, y) if v in (x, y) else v for v in label] if x != y else label
    assert 200 < len(links) < 400
    got = {r.doc_id: r.component_id for r in simhash.near_copies(docs_of(spark, texts)).collect()}
    assert [got[i] for i in range(2000)] == label



# --- clashing columns and wordless blocks ------------------------------------------------


def test_clashing_columns_of_classifier_and_mix(spark):
    docs = docs_of(spark, ["one two three"] * 30, source="s").withColumns({"quality_logit": F.lit("x"), "_size": F.lit("kept"), "_block": F.lit(3), "mix_shard": F.lit("gone")})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels, quality.good_label())
    rows = quality.classify(quality.with_evidence(docs, model), F.col("source"), F.col("lang"))
    assert rows.count() == 30 and rows.columns.count("quality_logit") == 1 and dict(rows.dtypes)["quality_logit"] == "double"
    mixed = mixing.mix(docs)
    assert {(r._size, r._block) for r in mixed.collect()} == {("kept", 3)} and dict(mixed.dtypes)["mix_shard"] != "string"


def test_wordless_rows_are_drawn_twice_at_most(spark):
    docs = docs_of(spark, ["", None, "   "] * 40 + ["a b"] * 3, source="small").unionByName(docs_of(spark, ["w " * 500] * 20, range(1000, 1020), source="zlarge"))
    times = mixing.mix(docs, weights=(3, 1)).groupBy("doc_id").count().agg(F.max("count")).first()[0]
    assert times <= 2


# --- WARC --------------------------------------------------------------------------------


def test_warc_odd_pages(spark):
    big = "p" * 150
    rows = [(5, "http://A.example.org/x", big), (3, "http://a.example.org/x", big), (9, None, big), (None, "u", big), (1, "", None), (2, "http://h/\n?q#f", ""), (2, "http://h/\n?q#f", ""), (3, "http://a.example.org/x", big), (7, "//h", "short"), (8, "h", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).withColumn("key", F.lit("k"))
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.archive_round_trip(pages, block_lines=2).collect())
    assert got == {(5, 150, "revisit", 3): 1, (3, 150, "response", None): 2, (9, 150, "revisit", 3): 1, (None, 150, "revisit", 3): 1, (1, 0, "response", None): 1, (2, 0, "response", None): 2, (7, 5, "response", None): 1, (8, 5, "response", None): 1}
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_warc_lookup_by_key_only(spark):
    rows = [(i, f"http://h{i % 7}.example.org/p{i % 3}", "x" * i) for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    root = shared_dir(spark, "t-warc")
    shards = warc.build_index(warc.write_archive(pages, root), root, block_lines=3)
    asked = spark.createDataFrame([("http://h2.example.org/p1",), ("http://none/",)], "url string").select(warc.url_key(F.col("url")).alias("key"), F.lit(None).cast("string").alias("capture"))
    hits = warc.lookup(spark, shards, root, asked)
    assert sorted(int(r.capture, 16) for r in hits.collect()) == [i for i in range(200) if i % 7 == 2 and i % 3 == 1]
    assert {r.page_id for r in warc.read_records(hits, root).collect()} == {i for i in range(200) if i % 7 == 2 and i % 3 == 1}


def test_url_key(spark):
    urls = spark.createDataFrame([("http://u:p@WWW.Example.org:80/a?b#c",), ("h/x",), (None,), ("https://h?q",)], "u string")
    assert [r[0] for r in urls.select(warc.url_key(F.col("u"))).collect()] == ["org,example,www)/a?b", "h)/x", "", "h)?q"]


# --- vectors -----------------------------------------------------------------------------


def plain_top(rows, k=5):
    out = []
    for q, v in rows:
        if q % 50 == 0:
            s = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q))[:k]
            out += [(q, n + 1, i, -p) for n, (p, i) in enumerate(s)]
    return sorted(out)


def test_exact_top_against_all(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 5
    rows = [(i, (centres[i % 6] + rng.normal(size=8)).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("pivot", F.lit(1))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in pivot_search.exact_top(frame, F.col("vec_id") % 50 == 0, block=40, n_pivots=8).collect())
    coded = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    assert got == plain_top(coded)


def test_exact_top_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [1.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, [0.0, 0.0]), (None, [1.0, 1.0]), (0, [1.0, 2.0]), (6, [-1.0, 3.0]), (7, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in pivot_search.exact_top(frame, F.col("vec_id") % 50 == 0).collect())
    kept = [(0, [256, 512]), (5, [0, 0]), (6, [-256, 768]), (7, [0, 0]), (50, [256, 0])]
    assert got == plain_top(kept)
    assert pivot_search.exact_top(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    large = spark.createDataFrame([(0, [3e6, 3e12]), (1, [3e6, 3e6]), (2, [1.0, 0.0])], "vec_id long, embedding array<double>")
    code = lambda v: [min(1 << 53, math.floor(256 * x)) for x in v]
    want = {1: sum(a * b for a, b in zip(code([3e6, 3e12]), code([3e6, 3e6]))), 2: 256 * code([3e6])[0]}
    got = {r.vec_id: r.score for r in pivot_search.exact_top(large, F.col("vec_id") == 0).collect()}
    assert got == {i: min(v, 2**63 - 1) for i, v in want.items()}


def test_permutation_recall_and_scores(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.vec_id: np.array(r.embedding, float) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    ids = sorted(rows)
    x = np.stack([rows[i] for i in ids])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in sorted(QUERIES["op8_permutation_neighbours"](spark, folder).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in ids if i % 50 == 0}
    found = 0
    for q, hits in got.items():
        s = unit @ unit[ids.index(q)]
        s[ids.index(q)] = -9
        want = {ids[j] for j in np.argsort(-s)[:5]}
        found += len(want & {v for v, _ in hits})
        assert all(abs(s[ids.index(v)] - p) < 1e-12 for v, p in hits)
        assert [p for _, p in hits] == sorted((p for _, p in hits), reverse=True)
    assert found / (5 * len(got)) >= 0.95


def test_permutation_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, [2.0, 1.0]), (1, None), (2, [1.0, None]), (5, [0.0, 0.0]), (6, [-1.0, 3.0]), *[(100 + i, [1.0, 2.0]) for i in range(1, 30)]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in permutation_search.permutation_top(frame, F.col("vec_id") == 0).collect())
    assert got == [(0, i, 100 + i) for i in range(1, 6)]
    few = spark.createDataFrame(rows[:6], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in permutation_search.permutation_top(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 50), (0, 6)]
    assert permutation_search.permutation_top(frame.limit(0), F.col("vec_id") == 0).count() == 0


# --- tokens, packing, planes -------------------------------------------------------------


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_encoder_is_the_library(name, small_docs):
    e = tokens.Encoder(tokens.tokenizer_path(name), cache=50)
    rng = np.random.default_rng(1)
    letters = ["a", "B", "é", "ß", " ", "  ", "\n", " \n", "\t", "'s", "1", "23", "!", "<|endoftext|>", " ", "́", "Σ", "世", "\x1c", "\r\n", "😀", "İ", "ª", ". ", "it's", " | "]
    texts = ["".join(rng.choice(letters, rng.integers(0, 14))) for _ in range(1500)] + [d["text"] for d in small_docs[:60]]
    for t in texts:
        assert e.encode(t).tolist() == e.library.encode(t, add_special_tokens=False).ids, repr(t)


def plain_ids(name, text):
    e = tokens.Encoder(tokens.tokenizer_path(name))
    return [*e.library.encode(text or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_packing(spark, small_docs):
    rows = QUERIES["op4_swap_packing"](spark, SMALL).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_bin[r.sequence_id].append(r)
    e = tokens.Encoder(tokens.tokenizer_path(tokens.BYTE_BPE))
    total = 0
    for d in small_docs:
        ids = [*e.library.encode(d["text"], add_special_tokens=False).ids, 2]
        total += len(ids)
        parts = sorted(by_doc[d["doc_id"]], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // 1024)))
        assert all(r.length == 1024 for r in parts[1:]) and sum(r.length for r in parts) == len(ids)
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == crc(ids[at : at + r.length])
            at += r.length
    for parts in by_bin.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_bin) <= -(-total // 1024) + 1


def test_local_search_empties_bins():
    sizes = [6, 5, 5, 4, 4, 3, 3]
    start = [[0], [1, 3], [2, 4], [5, 6]]
    search = packing.LocalSearch(sizes, start, 10)
    bins = search.run()
    assert len(bins) == 3 and sorted(i for b in bins for i in b) == list(range(7)) and all(sum(sizes[i] for i in b) <= 10 for b in bins)


def test_local_search_never_loses():
    rng = np.random.default_rng(9)
    for _ in range(30):
        sizes = rng.integers(1, 400, 60).tolist()
        bins = packing.LocalSearch(sizes, [[i] for i in range(60)], 1000).run()
        assert sorted(i for b in bins for i in b) == list(range(60)) and all(sum(sizes[i] for i in b) <= 1000 for b in bins)
        assert len(bins) <= -(-sum(sizes) // 1000) + 1


def test_packing_odd_rows(spark):
    frame = docs_of(spark, [*ODD, "twice", "twice"], [*range(len(ODD)), 99, 99]).withColumn("piece", F.lit(5)).withColumn("_group", F.lit(5))
    got = packing.pack_documents(frame).collect()
    assert sum(r.length for r in got) == sum(len(plain_ids(tokens.BYTE_BPE, t)) for t in [*ODD, "twice", "twice"])
    assert len([r for r in got if r.doc_id == 99]) == 2 and len({(r.sequence_id, r.offset) for r in got}) == len(got)
    assert packing.pack_documents(frame.limit(0)).count() == 0


def test_id_files(spark, small_docs):
    got = sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in QUERIES["op6_bit_plane_ids"](spark, SMALL).collect())
    want, at = [], 0
    e = tokens.Encoder(tokens.tokenizer_path(tokens.WORD_BPE))
    for d in sorted(small_docs, key=lambda d: d["doc_id"]):
        ids = [*e.library.encode(d["text"], add_special_tokens=False).ids, 2]
        want.append((d["doc_id"], at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want


@pytest.mark.parametrize("bits", [False, True])
def test_id_files_odd_rows(spark, bits):
    frame = docs_of(spark, [*ODD, "b", "a"], [*range(len(ODD)), None, 3]).withColumn("start", F.lit(0))
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in planes.id_files_round_trip(frame, block=64, bits=bits).orderBy("start").collect()]
    order = sorted(zip([*range(len(ODD)), None, 3], [*ODD, "b", "a"]), key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    at = 0
    for (d, t), row in zip(order, got, strict=True):
        ids = plain_ids(tokens.WORD_BPE, t)
        assert row == (d, at, len(ids), crc(ids))
        at += len(ids)
    assert planes.id_files_round_trip(frame.limit(0)).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    assert (planes.from_planes(planes.to_planes(ids, bits), n, bits) == ids).all()


# --- licences ----------------------------------------------------------------------------


def test_licenses_merge_diagonals_and_odd_rows(spark):
    broken = "permission is hereby granted free of any charge to any person obtaining copy of this software"
    texts = [*ODD, broken, "GNU General, Public-License; x mit license"]
    rows = docs_of(spark, texts).withColumn("pos", F.lit(1)).withColumn("label", F.lit("q"))
    got = {r.doc_id: r for r in licenses.license_scan(rows).collect()}
    assert [got[i].n_words for i in range(4)] == [0, 0, 0, 1]
    m = got[len(ODD) - 1]
    assert (m.n_base, m.first_word, m.last_word, m.base_labels) == (3, 0, 4, "cc-by,mit")
    b = got[len(ODD)]
    assert (b.n_base, b.base_labels, b.labels) == (0, "", "mit") and 0.7 <= b.score < 1
    assert (got[len(ODD) + 1].first_word, got[len(ODD) + 1].last_word) == (0, 5)
    twice = licenses.license_scan(docs_of(spark, ["mit license", "mit license", "cc by"], [1, 1, None])).collect()
    assert Counter((r.doc_id, r.n_base) for r in twice) == {(1, 1): 2, (None, 1): 1}
    assert licenses.license_scan(rows.limit(0)).count() == 0


# --- mixing ------------------------------------------------------------------------------


def test_mix_targets_and_repeats(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), "en", ["a", "b", "c", "d", None][int(rng.integers(0, 5)) if i % 3 else 0], 0) for i in range(3000)]
    frame = spark.createDataFrame(rows, DOCS)
    first, second = (sorted(map(tuple, mixing.mix_summary(frame).collect()), key=repr) for _ in range(2))
    assert first == second
    taken, target, size = Counter(), {}, Counter()
    source = {r[0]: r[3] for r in rows}
    for d, s, _, t, k, _ in first:
        assert 0 <= k <= 2 * s
        taken[source[d]] += k
        target[source[d]] = t
        size[source[d]] += s
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6 * sum(size.values())
    for s in target:
        assert target[s] <= 2 * size[s] + 1e-6 and abs(taken[s] - target[s]) <= 60
    drawn = mixing.mix(frame)
    assert drawn.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    shards = [r["count"] for r in drawn.groupBy("mix_shard").count().collect()]
    assert len(shards) == 16 and max(shards) < 1.5 * min(shards)


def test_splitting_tree_is_exact(spark):
    quotas = spark.createDataFrame([("a", 1000), ("b", 10), (None, 333), ("c", 1)], "_source string, units long")
    rows = mixing.splitting_tree(quotas).collect()
    got = defaultdict(list)
    shard = Counter()
    for r in rows:
        got[r._source].append((r.from_unit, r.to_unit))
        shard[r.shard] += r.to_unit - r.from_unit
    for s, n in (("a", 1000), ("b", 10), (None, 333), ("c", 1)):
        spans = sorted(got[s])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    assert set(shard.values()) == {84}


def test_hypergeometric_draws(spark):
    n = 4000
    frame = spark.range(n).select(mixing._draw(F.lit(50), F.lit(20), F.lit(10), (F.col("id") + 0.5) / n).alias("x"))
    got = Counter(r.x for r in frame.collect())
    want = {x: math.comb(20, x) * math.comb(30, 10 - x) / math.comb(50, 10) for x in range(11)}
    assert all(abs(got[x] / n - want[x]) < 2e-3 for x in want)


def test_mix_odd_rows(spark):
    frame = docs_of(spark, ODD).withColumn("mix_shard", F.lit(1)).withColumn("size", F.lit(2)).withColumn("target", F.lit(2))
    got = mixing.mix_summary(frame).collect()
    assert len(got) == len(ODD) and [r.size for r in sorted(got, key=lambda r: r.doc_id)][:5] == [0, 0, 0, 1, 2]
    assert mixing.mix(frame).count() >= 0
    assert mixing.mix_summary(frame.limit(0)).count() == 0 and mixing.mix(frame.limit(0)).count() == 0
    empty = mixing.mix_summary(docs_of(spark, ["", None])).collect()
    assert [(r.size, r.target, r.taken) for r in empty] == [(0, 0.0, 0)] * 2


# --- quality -----------------------------------------------------------------------------


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.where(F.pmod(F.xxhash64("doc_id", F.lit("split")), F.lit(3)) > 0)
    model = quality.fit(docs, train, quality.good_label())
    rows = quality.classify(quality.with_evidence(docs, model), F.col("source"), F.col("lang"))
    assert rows.count() == docs.count()
    held = rows.join(labels.join(train, "doc_id", "left_anti"), "doc_id").select("quality_keep", "quality", "toxic").collect()
    junk = [r.quality_keep for r in held if r.quality == 0]
    clean = [r.quality_keep for r in held if r.quality == 1 and r.toxic == 0]
    assert sum(clean) / len(clean) >= 0.97 and 1 - sum(junk) / len(junk) >= 0.8  # a few hundred labels to learn from


def test_quality_shrinks_sparse_hosts(spark):
    rows = [(i, "big", "x", 2.0 if i % 10 else -2.0) for i in range(1000)] + [(2000, "one", "x", -2.0)] + [(3000 + i, "bad", "x", -4.0) for i in range(500)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, quality_logit double")
    got = {r.host: r for r in quality.posteriors(frame, F.col("source"), F.col("lang")).collect()}
    rate = got["one"].global_rate
    assert abs(got["one"].host_rate - rate) < abs(1 / (1 + math.exp(2.0)) - rate)
    assert got["bad"].path_rate < 0.1 < rate < got["big"].path_rate


def test_quality_odd_rows(spark):
    docs = docs_of(spark, ODD).withColumn("host", F.lit(1)).withColumn("n", F.lit(1)).withColumn("source", F.when(F.col("doc_id") % 2 == 0, F.col("source")))
    labels = spark.createDataFrame([(i, i % 2, None if i % 3 else 0) for i in range(len(ODD))] + [(None, 1, 1), (500, 1, 0)], "doc_id long, quality int, toxic int")
    for l in (labels, labels.limit(0), labels.where("quality = 1")):
        model = quality.fit(docs, l, quality.good_label())
        rows = quality.classify(quality.with_evidence(docs, model), F.col("source"), F.col("lang")).collect()
        assert len(rows) == len(ODD) and all(0 <= r.quality_score <= 1 for r in rows)
        assert quality.classify(quality.with_evidence(docs.limit(0), model), F.col("source"), F.col("lang")).count() == 0


# --- chaining ----------------------------------------------------------------------------


def plain_chain(points, k, gap):
    points = sorted(points)
    score = []
    for i, (x, y) in enumerate(points):
        score.append(k + max([0.0, *(score[j] - gap * (x - points[j][0] + y - points[j][1]) for j in range(i) if points[j][0] < x and points[j][1] < y)]))
    return max(score)


def test_fenwick_chains_against_all_predecessors():
    rng = np.random.default_rng(7)
    for _ in range(40):
        points = list({(int(a), int(b)) for a, b in rng.integers(0, 60, (25, 2))})
        found = chaining.chains(np.array([p[0] for p in points]), np.array([p[1] for p in points]), 8, 0.3)
        assert sorted(p for c in found for p in c) == sorted(points)
        best = found[0]
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(best, best[1:]))
        total = 8 * len(best) - 0.3 * sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(best, best[1:]))
        assert abs(total - plain_chain(points, 8, 0.3)) < 1e-9


def test_every_long_run_holds_a_seed():
    words = [w.encode() for w in prose(600, 8)]
    h, at = chaining.seeds_of(words, 8, 20)
    assert max(np.diff(at)) <= 20
    other = [w.encode() for w in prose(100, 9)] + words[200:227] + [w.encode() for w in prose(50, 10)]
    assert set(h.tolist()) & set(chaining.seeds_of(other, 8, 20)[0].tolist())


def test_passages_exact_and_fuzzy(spark):
    p = prose(60, 20)
    q = prose(90, 21)
    fuzzy = [*q[:30], "x1", *q[31:60], "ins", *q[60:]]
    short = prose(40, 22)
    texts = [
        " ".join([*prose(100, 30), *p, *prose(70, 31)]),
        " ".join([*prose(20, 32), *[w.upper() for w in p], *prose(80, 33), *short]),
        " ".join([*q, *prose(100, 34)]),
        " ".join([*prose(55, 35), *fuzzy, *prose(10, 36)]),
        " ".join([*short, *prose(200, 37)]),
        " ".join([*p, *prose(5, 38), *p]),
        None,
        "",
    ]
    frame = docs_of(spark, texts).withColumn("pos", F.lit(1)).withColumn("seed", F.lit(1))
    got = {(r.doc_id, r.ref_id, r.start): r for r in chaining.passages(frame).collect()}
    assert set(got) == {(1, 0, 20), (3, 2, 55), (5, 0, 0), (5, 0, 65)}
    assert (got[1, 0, 20].length, got[1, 0, 20].ref_start, got[1, 0, 20].identity) == (60, 100, 1.0)
    assert got[3, 2, 55].length == 91 and got[3, 2, 55].equal_words == 89
    cut = {r.doc_id: r.text for r in chaining.without_passages(frame, chaining.passages(frame)).collect()}
    assert cut[0] == texts[0] and cut[2] == texts[2] and cut[4] == texts[4] and cut[6] is None and cut[7] == ""
    assert cut[1].split() == [*prose(20, 32), *prose(80, 33), *short]
    assert cut[5].split() == prose(5, 38)
    assert cut[3].split() == [*prose(55, 35), *prose(10, 36)]
    assert chaining.passages(frame.limit(0)).count() == 0
    twice = chaining.passages(docs_of(spark, [texts[0], texts[0], texts[1], " ".join(p)], [1, 1, 2, None])).collect()
    assert {(r.doc_id, r.ref_id) for r in twice} == {(2, 1)}


def test_exact_passages_whose_parts_stand_earlier(spark):
    cases, texts = [], []
    for n, parts in enumerate([[(0, 30), (30, 60)], [(0, 40), (40, 80)], [(0, 20), (20, 40), (40, 60)], [(0, 45), (10, 55), (20, 65)], [(0, 49), (1, 50)]]):
        for again in range(6):
            p = prose(parts[-1][1], 1000 + 10 * n + again)
            for a, b in parts:
                texts.append([*prose(15, 2000 + len(texts)), *p[a:b], *prose(15, 3000 + len(texts))])
            texts.append([*prose(30, 2000 + len(texts)), *p, *prose(30, 3000 + len(texts))])
            cases.append((len(texts), len(texts) - 1, len(p)))
            texts.append([*prose(35, 2000 + len(texts)), *p, *prose(30, 3000 + len(texts))])
    rows = chaining.passages(docs_of(spark, [" ".join(t) for t in texts])).collect()
    assert all(texts[r.doc_id][r.start : r.start + r.length] == texts[r.ref_id][r.ref_start : r.ref_start + r.ref_length] for r in rows)
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id, r.ref_id].update(range(r.start, r.start + r.length))
    assert got == {(doc, ref): set(range(35, 35 + size)) for doc, ref, size in cases}


def test_remove_spans_keeps_other_bytes():
    assert chaining.remove_spans("a  b\nc d\t e ", [(1, 3)]) == "a  d\t e "
    assert chaining.remove_spans(" a b", [(0, 1)]) == " b"
    assert chaining.remove_spans("a b", [(0, 2)]) == ""
    assert chaining.remove_spans("a b c", [(0, 1), (0, 2), (1, 2)]) == "c"


# --- pipeline ----------------------------------------------------------------------------


def test_pipeline_stages(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["keep_good", "drop_near_copies", "cut_passages", "mix_sources", "pack_sequences"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        path = shared_dir(spark, "stage")
        stage(spark, docs, SMALL).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        assert docs.columns == names and docs.count() > 0
    assert before.count() > 0
    last = corpus_pipeline.pack_sequences(spark, docs, SMALL)
    assert last.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_near_copy_stage_keeps_one(spark):
    base = prose(200, 50)
    near = [*base[:100], "z", *base[101:]]
    frame = docs_of(spark, [" ".join(base), " ".join(near), " ".join(base), " ".join(base), "other text here for one", "none"], [7, 5, 7, 9, None, 1])
    got = sorted((r.doc_id is None, r.doc_id or 0) for r in corpus_pipeline.drop_near_copies(spark, frame, SMALL).collect())
    assert got == [(False, 1), (False, 5), (True, 0)]


def test_pipeline_on_odd_rows(spark):
    docs = docs_of(spark, ODD)
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SMALL)
    assert docs.count() > 0
    empty = docs_of(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SMALL)
    assert empty.count() == 0
