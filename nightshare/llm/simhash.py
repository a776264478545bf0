"""SimHash near-duplicates: fingerprints from whole texts, bit-sliced comparison inside buckets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshare.llm.common import saved, whole_groups
from nightshare.llm.graph import components

SEED, SHINGLE, RADIUS, LANES, TILE = 42, 3, 2, 4096, 2048
#: Nodes of a slice and leaders of a group where sets are compared; bits of the filter of ids at most (16 MB).
SLICE, LEADERS, ID_BITS = 512, 32, 1 << 27


def shingle_hashes(text: str | None, words: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle, repeats included; fewer words make one shingle, none makes none."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        grams = [b" ".join(parts)]
    else:
        grams = map(b" ".join, zip(*(parts[i:] for i in range(words)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(g, seed) for g in grams), np.uint64)


def mixed(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th further hash of hashes (0: the hashes themselves)."""
    if k == 0:
        return h
    x = h + np.uint64((k * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority(h: np.ndarray, piece: int = 1 << 16) -> int:
    """Bits set in over half of the hashes; hashes are counted piece by piece, so long texts need no more memory."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(h), piece):
        counts += np.unpackbits(h[i : i + piece].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(h)).tobytes(), "big") if len(h) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, parts: int = 1, keys: int = 0) -> DataFrame:
    """(doc_id, fingerprint of 8 * parts bytes, keys): keys are ``keys`` smallest shingle hashes under different hashes."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, mins = [], []
            for text in batch.column(1):
                h = shingle_hashes(text.as_py(), shingle, seed)
                prints.append(b"".join(majority(mixed(h, k)).to_bytes(8, "big") for k in range(parts)))
                mins.append([int(mixed(h, 1000 + k).min().astype(np.int64)) for k in range(keys)] if len(h) else [0] * keys)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.binary()), pa.array(mins, pa.list_(pa.int64()))], names=["doc_id", "fingerprint", "keys"])

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {id_type}, fingerprint binary, keys array<bigint>")


# --- bit-sliced comparison ---------------------------------------------------------------


def bit_planes(values: np.ndarray) -> list[int]:
    """(n, bytes) uint8 -> one Python integer per bit position, holding that bit of all n values."""
    bits = np.unpackbits(values, axis=1).T
    return [int.from_bytes(np.packbits(row, bitorder="little").tobytes(), "little") for row in bits]


def within(planes: list[int], shift: int, live: int, radius: int) -> int:
    """Lanes i of ``live`` whose value differs from that of lane i + shift in at most ``radius`` bits.

    All lanes count at once: each bit plane goes through a chain of carry-save counters, one
    integer per counter bit. The counters start so that they overflow at radius + 1; the
    overflow sticks, and the block is left as soon as every live lane has overflowed.
    """
    width = (radius + 1).bit_length()
    start = (1 << width) - 1 - radius
    counters = [live if start >> b & 1 else 0 for b in range(width)]
    for plane in planes:
        carry = (plane ^ (plane >> shift)) & live
        for b in range(width):
            carry, counters[b] = counters[b] & carry, counters[b] ^ carry
            if not carry:
                break
        if carry:
            live &= ~carry
            if not live:
                return 0
    return live


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """Roots of n lanes after the links a-b are added to ``root``."""
    while True:
        ra, rb = root[a], root[b]
        if np.array_equal(ra, rb):
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, up := root[root]):
            root = up


def spanning_links(values: np.ndarray, group: np.ndarray, radius: int, lanes: int = LANES) -> np.ndarray:
    """Rows sorted by group -> root row of each row, over the links within groups.

    Every pair of rows of one group is compared (in lanes, shift by shift). Only rows in groups
    with a partner at that shift stay, so small groups cost a few shifts.
    """
    n = len(values)
    root = np.arange(n)
    edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, int)
    sizes = np.diff(np.r_[edges, n])
    for lo, hi in _blocks(edges, sizes, lanes):
        own = slice(lo, hi)
        planes, g = bit_planes(values[own]), group[own]
        size = hi - lo
        for shift in range(1, int(sizes[(edges >= lo) & (edges < hi)].max())):
            same = np.flatnonzero(g[: size - shift] == g[shift:])
            if not len(same):
                break
            mask = np.zeros(size, bool)
            mask[same] = True
            alive = within(planes, shift, int.from_bytes(np.packbits(mask, bitorder="little").tobytes(), "little"), radius)
            if alive:
                at = np.flatnonzero(np.unpackbits(np.frombuffer(alive.to_bytes((size + 7) // 8, "little"), np.uint8), bitorder="little")) + lo
                root = _roots(n, at, at + shift, root)
    return root


def _blocks(edges: np.ndarray, sizes: np.ndarray, lanes: int) -> Iterator[tuple[int, int]]:
    """Runs of whole groups of about ``lanes`` rows; small and large groups do not share a run."""
    lo, total, most = 0, 0, 0
    for e, s in zip(edges.tolist(), sizes.tolist(), strict=True):
        if total and (total + s > lanes or s > 4 * most + 16):
            yield lo, e
            lo, total, most = e, 0, 0
        total, most = total + s, max(most, s)
    if total:
        yield lo, lo + total


def bucket_links(members: DataFrame, radius: int, tile: int = TILE) -> DataFrame:
    """``members`` (bucket, value binary, node) -> links (a, b) that connect what a bucket's comparisons connect.

    Buckets over ``tile`` rows are cut into tiles by the node's hash, and each pair of tiles is a
    task of its own; no bucket meets in one task, and none is cut short. Only a spanning set of
    links leaves a tile pair.
    """
    node_type = members.schema["node"].dataType.simpleString()
    members = saved(members.distinct(), "members")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumnRenamed("bucket", "k")
    tiles = F.ceil(F.col("n") / tile)
    own = F.pmod(F.xxhash64(F.lit("tile"), "node"), tiles)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1), lambda t: F.struct(F.least(t, F.col("own")).alias("lo"), F.greatest(t, F.col("own")).alias("hi")))
    dealt = members.join(sizes, F.col("bucket") == F.col("k")).withColumn("tiles", tiles).withColumn("own", own).select("bucket", "node", "value", F.inline(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("bucket", "lo", "hi")):
            bucket, lo, hi = (t[c].to_numpy() for c in ("bucket", "lo", "hi"))
            edge = np.r_[True, (bucket[1:] != bucket[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]
            values = np.frombuffer(b"".join(t["value"].to_pylist()), np.uint8).reshape(t.num_rows, -1)
            root = spanning_links(values, np.cumsum(edge), radius)
            at = np.flatnonzero(root != np.arange(t.num_rows))
            if len(at):
                yield pa.RecordBatch.from_arrays([t["node"].take(pa.array(i)).combine_chunks() for i in (at, root[at])], names=["a", "b"])

    return dealt.repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi").mapInArrow(run, f"a {node_type}, b {node_type}")


# --- operators ---------------------------------------------------------------------------


def _block_pairs(radius: int) -> list[tuple[int, int]]:
    """Bit masks of two of radius + 2 blocks: values within the radius agree on at least one of them."""
    blocks = radius + 2
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(blocks)]
    return [(masks[i] | masks[j], i * blocks + j) for i in range(blocks) for j in range(i + 1, blocks)]


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents whose 64-bit fingerprints link at ``radius`` or fewer differing bits.

    Equal fingerprints collapse to one node first, so copies are never compared. Nodes go to
    buckets by two of radius + 2 bit blocks, on one of which linked values must agree; a bucket
    is compared bit-sliced. No link between different fingerprints is lost.

    Null and empty texts have fingerprint zero and link like any other. Repeated rows give
    repeated results. A null id takes part; component_id is the smallest id that is not null
    (null if there is none). An empty table gives an empty result; other columns are ignored.
    """
    prints = fingerprints(docs, id_col, text_col, shingle, seed).select("doc_id", F.hex("fingerprint").alias("hex"))
    prints = saved(prints.select("doc_id", F.lower("hex").alias("fingerprint"), F.expr("shiftleft(cast(conv(substring(hex, 1, 8), 16, 10) as bigint), 32) | cast(conv(substring(hex, 9, 8), 16, 10) as bigint)").alias("node")), "prints")
    nodes = saved(prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("fingerprint").alias("fingerprint")), "nodes")
    signed = [(m - (1 << 64) if m >> 63 else m, k) for m, k in _block_pairs(radius)]
    tables = F.array(*[F.xxhash64(F.lit(k), F.col("node").bitwiseAND(F.lit(m).cast("long"))) for m, k in signed])
    members = nodes.select(F.explode(tables).alias("bucket"), F.unhex("fingerprint").alias("value"), "node")
    roots = components(bucket_links(members, radius)).withColumnRenamed("node", "n")
    rooted = saved(nodes.join(roots, F.col("node") == F.col("n"), "left").select("node", F.coalesce("root", "node").alias("root"), "first"), "roots")
    smallest = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    labels = saved(rooted.join(smallest, "root").select(F.col("node").alias("n"), "component_id"), "labels")
    return prints.join(labels, F.col("node") == F.col("n")).select("doc_id", "fingerprint", "component_id")


def similarity_radius(similarity: float, bits: int, margin: float = 4) -> int:
    """Differing bits of texts of that Jaccard similarity: the expected number and ``margin`` standard deviations more."""
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * p + margin * math.sqrt(bits * p * (1 - p)))


def _set_prints(docs: DataFrame, id_col: str, text_col: str, shingle: int, seed: int, parts: int, keys: int) -> DataFrame:
    """(doc_id, digest of the set of shingles, its fingerprint of 8 * parts bytes, keys); a shingle counts once, however often it stands."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, prints, mins = [], [], []
            for text in batch.column(1):
                h = np.unique(shingle_hashes(text.as_py(), shingle, seed))
                digests.append(hashlib.blake2b(h.tobytes(), digest_size=16).digest())
                prints.append(b"".join(majority(mixed(h, k)).to_bytes(8, "big") for k in range(parts)))
                mins.append([int(mixed(h, 1000 + k).min().astype(np.int64)) for k in range(keys)] if len(h) else [0] * keys)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary()), pa.array(prints, pa.binary()), pa.array(mins, pa.list_(pa.int64()))], names=["doc_id", "digest", "fingerprint", "keys"])

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {id_type}, digest binary, fingerprint binary, keys array<bigint>")


def id_bits(holders: DataFrame, count: int) -> np.ndarray:
    """One bit per hash of ``holder``, as bytes; at most ``ID_BITS`` bits however many there are."""
    bits = min(ID_BITS, 1 << max(15, (16 * count).bit_length()))
    place = F.pmod(F.xxhash64("holder"), F.lit(bits)) + 1
    maps = holders.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bitmap"))
    out = np.zeros(bits // 8, np.uint8)
    for bucket, bitmap in maps.collect():  # at most ID_BITS bits in all
        out[(bucket - 1) * 4096 : bucket * 4096] = np.frombuffer(bitmap, np.uint8)[: max(0, len(out) - (bucket - 1) * 4096)]
    return out


def _shingle_sets(docs: DataFrame, id_col: str, text_col: str, holders: DataFrame, shingle: int, seed: int) -> DataFrame:
    """(node, shingles): the set of shingle hashes of each node of ``holders`` (node, holder).

    Texts stay where they are: a bit filter of the holders' ids says which ones to hash, and only their sets travel.
    """
    count = holders.count()
    sent = docs.sparkSession.sparkContext.broadcast(id_bits(holders, count))  # bounded by ID_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            place = batch.column(0).to_numpy() % (len(bits) * 8)
            for i in np.flatnonzero(bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).tolist():
                h = np.unique(shingle_hashes(batch.column(2)[i].as_py(), shingle, seed)).view(np.int64)
                digest = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                sets = pa.ListArray.from_arrays(pa.array([0, len(h)], pa.int32()), pa.array(h))
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), pa.array([digest], pa.binary()), sets], names=["id", "digest", "shingles"])

    id_type = docs.schema[id_col].dataType.simpleString()
    hashed = docs.select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id"), text_col).mapInArrow(run, f"id {id_type}, digest binary, shingles array<bigint>")
    # Rows of one id may hold other texts, and a node's holder may stand in several rows.
    keyed = hashed.select("id", F.xxhash64("digest").alias("n"), "shingles")
    found = keyed.join(holders, (F.col("n") == F.col("node")) & F.col("id").eqNullSafe(F.col("holder")))
    return found.groupBy("node").agg(F.first("shingles").alias("shingles"))


def shared_counts(sets: list[np.ndarray], others: list[np.ndarray], piece: int = 4096) -> np.ndarray:
    """Size of the intersection of every set with every other one; values that stand on one side only are not looked at."""
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (sets, others))
    known = np.intersect1d(a, b)
    out = np.zeros((len(sets), len(others)), np.float32)
    rows = [np.repeat(np.arange(len(x)), [len(v) for v in x]) for x in (sets, others)]
    places = [np.searchsorted(known, v) for v in (a, b)]
    held = [(p < len(known)) & (known[np.minimum(p, len(known) - 1)] == v) if len(known) else np.zeros(len(v), bool) for p, v in zip(places, (a, b))]
    rows, places = [r[h] for r, h in zip(rows, held)], [p[h] for p, h in zip(places, held)]
    for at in range(0, len(known), piece):
        parts = []
        for n, r, p in zip((len(sets), len(others)), rows, places):
            m = np.zeros((n, min(piece, len(known) - at)), np.float32)
            own = (p >= at) & (p < at + piece)
            m[r[own], p[own] - at] = 1
            parts.append(m)
        out += parts[0] @ parts[1].T
    return out


def exact_links(sets: list[np.ndarray], others: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (row of sets, row of others) of that Jaccard similarity or more; two empty sets are alike."""
    both = shared_counts(sets, others)
    total = np.array([len(x) for x in sets])[:, None] + np.array([len(x) for x in others])[None, :] - both
    return np.nonzero(both >= similarity * total)


def _alike(rows: DataFrame, similarity: float) -> DataFrame:
    """``rows`` (group, slice, node, label, probe, shingles) -> links (a, b) that connect a slice's nodes with each other and with the probes sent to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ("group", "slice")):
            group, part, node, label, probe = (t[c].to_numpy() for c in ("group", "slice", "node", "label", "probe"))
            sets = t["shingles"].combine_chunks()
            values, bounds = sets.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])
            own = [values[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            edges = np.r_[np.flatnonzero(np.r_[True, (group[1:] != group[:-1]) | (part[1:] != part[:-1])]), len(group)]
            found = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
                left, right = lo + np.flatnonzero(probe[lo:hi] != 1), lo + np.flatnonzero(probe[lo:hi] != 0)
                if len(left) and len(right):
                    i, j = exact_links([own[x] for x in left], [own[x] for x in right], similarity)
                    i, j = left[i], right[j]
                    differ = label[i] != label[j]
                    names = np.unique(np.concatenate([label[left], label[right]]))
                    i, j = i[differ], j[differ]
                    x, y = np.searchsorted(names, label[i]), np.searchsorted(names, label[j])
                    root = _roots(len(names), x, y, np.arange(len(names)))
                    out = np.flatnonzero(root != np.arange(len(names)))
                    found.append(np.stack([names[out], names[root[out]]]))
            if found and (pairs := np.concatenate(found, axis=1)).size:
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return rows.repartition("group", "slice").sortWithinPartitions("group", "slice").mapInArrow(run, "a bigint, b bigint")


def checked_links(sets: DataFrame, similarity: float, part: int = SLICE, leaders: int = LEADERS) -> DataFrame:
    """``sets`` (group, node, shingles) -> links (a, b) that connect the nodes of a group as all its pairs of that similarity do.

    A group is cut into slices of about ``part`` nodes by their hash. First every slice is compared in itself and with the
    group's ``leaders``, which connects most of a large group of copies. Then the nodes outside the group's largest class so far are
    compared with all its slices, in blocks; within that class nothing is left to find. All comparisons are of whole sets.
    """
    sizes = sets.groupBy("group").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("group", "g")
    rows = sets.join(sizes, F.col("group") == F.col("g")).drop("g").withColumn("slices", F.ceil(F.col("n") / part))
    order = F.xxhash64(F.lit("leader"), "node")
    own = rows.withColumn("slice", F.pmod(F.xxhash64(F.lit("slice"), "node"), F.col("slices"))).withColumn("label", F.col("node"))
    # A group's leaders are its nodes of smallest hash: those below the share that gives about as many, once for each slice.
    large = own.where("slices > 1")
    first = large.where(F.pmod(order, F.col("n")) < leaders).withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    shape = ["group", "slice", "node", "label", "probe", "shingles"]
    # probe: 0 a slice's own node, 1 a probe only, 2 both
    one = own.withColumn("probe", F.lit(2)).select(*shape).unionByName(first.withColumn("probe", F.lit(1)).select(*shape))
    links = saved(_alike(one, similarity), "alike")
    roots = components(links).withColumnRenamed("node", "n1")
    named = large.join(roots, F.col("node") == F.col("n1"), "left").withColumn("label", F.coalesce("root", "node")).drop("n1", "root")
    named = saved(named.select("group", "slice", "slices", "node", "label", "shingles"), "named")
    counts = named.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy(F.col("group").alias("g")).agg(F.max(F.struct("n", "label")).alias("m")).select("g", F.col("m.label").alias("most"))
    others = named.join(most, F.col("group") == F.col("g")).where("label <> most")
    # Blocks of the others: each meets each slice in a task of its own.
    blocks = others.groupBy(F.col("group").alias("k")).agg(F.ceil(F.count(F.lit(1)) / part).alias("blocks"))
    others = others.join(blocks, F.col("group") == F.col("k")).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("blocks")))
    sent = others.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).withColumn("slice", F.col("slice") * F.col("blocks") + F.col("block")).withColumn("probe", F.lit(1))
    met = named.join(blocks, F.col("group") == F.col("k")).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    met = met.withColumn("slice", F.col("slice") * F.col("blocks") + F.col("block")).withColumn("probe", F.lit(0))
    return links.unionByName(saved(_alike(sent.select(*shape).unionByName(met.select(*shape)), similarity), "alike"))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8, parts: int = 8, keys: int = 8, seed: int = SEED) -> DataFrame:
    """(doc_id, component_id) of every row: groups of texts linked by a Jaccard similarity of ``similarity`` or more of their sets of word shingles.

    Texts of one set of shingles form a node. Wide fingerprints (64 * parts bits) of the sets are
    compared bit-sliced inside buckets; nodes share a bucket where one of ``keys`` smallest
    shingle hashes agrees, which misses a pair of Jaccard similarity s with probability
    (1 - s) ** keys. The fingerprints, with four standard deviations to spare, only join nodes to groups that
    may hold links; in a group the sets themselves are compared, and only exact links count.

    Null and empty texts have no words and form one group. Repeated rows give repeated results; a null id
    takes part, component_id being the smallest id that is not null (null if there is none). Texts are read whole,
    whatever their length. An empty table gives no rows; other columns are ignored.
    """
    prints = saved(_set_prints(docs, id_col, text_col, shingle, seed, parts, keys).withColumn("node", F.xxhash64("digest")), "wide")
    classes = saved(prints.groupBy("node").agg(F.min("doc_id").alias("first"), F.min(F.struct("fingerprint", "keys")).alias("p")).select("node", "first", "p.fingerprint", "p.keys"), "classes")
    members = classes.select(F.posexplode("keys").alias("k", "key"), F.col("fingerprint").alias("value"), "node").select(F.xxhash64("k", "key").alias("bucket"), "value", "node")
    loose = components(bucket_links(members, similarity_radius(similarity, 64 * parts))).withColumnRenamed("root", "group")
    loose = saved(loose, "loose")
    holders = saved(prints.join(loose.select(F.col("node").alias("n")), F.col("node") == F.col("n"), "left_semi").groupBy("node").agg(F.min("doc_id").alias("holder")), "holders")
    sets = _shingle_sets(docs, id_col, text_col, holders, shingle, seed).join(loose.withColumnRenamed("node", "n"), F.col("node") == F.col("n")).select("group", "node", "shingles")
    roots = components(checked_links(saved(sets, "sets"), similarity)).withColumnRenamed("node", "n")
    rooted = saved(classes.join(roots, F.col("node") == F.col("n"), "left").select("node", F.coalesce("root", "node").alias("root"), "first"), "roots")
    smallest = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    labels = saved(rooted.join(smallest, "root").select(F.col("node").alias("n"), "component_id"), "labels")
    return prints.join(labels, F.col("node") == F.col("n")).select("doc_id", "component_id")
