"""Best-fit packing of token pieces, improved by a swap-based local search."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightshare.llm.common import saved
from nightshare.llm.tokens import BYTE_BPE, encoder, tokenizer_path

CAPACITY, END, GROUP = 1024, 2, 1 << 16


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): documents over ``capacity`` tokens are cut, the first piece takes what is left over."""
    path, id_type = path or tokenizer_path(BYTE_BPE), docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_all
        for batch in batches:
            out = []
            for i, found in enumerate(encode(batch.column(1))):
                ids = np.append(found, np.uint32(end)).astype("<u4")
                cuts = [0, *range(len(ids) - capacity * ((len(ids) - 1) // capacity), len(ids) + 1, capacity)]
                out += [(i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            if out:
                at, piece, start, length, crc = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).alias("doc_id"), text_col).mapInArrow(run, f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint")


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit in falling order of size; the set of free spaces is one integer's bits."""
    bins, free, spaces = [], defaultdict(list), 0
    for i in sorted(range(len(sizes)), key=lambda j: (-sizes[j], j)):
        above = spaces >> sizes[i]
        if above:
            space = (above & -above).bit_length() - 1 + sizes[i]
            b = free[space].pop()
            if not free[space]:
                spaces &= ~(1 << space)
            bins[b].append(i)
        else:
            space, b = capacity, len(bins)
            bins.append([i])
        left = space - sizes[i]
        if left:
            free[left].append(b)
            spaces |= 1 << left
    return bins


class LocalSearch:
    """Moves, one-for-one and two-for-one exchanges between underfull bins.

    Each step shifts tokens from a lighter bin to one at least as full, so the sum of squared
    fills rises; the lightest bins empty. The search ends when the bins are as few as the sizes
    allow, or when no step helps any of the lightest bins.
    """

    def __init__(self, sizes: list[int], bins: list[list[int]], capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bins = {b: list(items) for b, items in enumerate(bins)}
        self.fill = {b: sum(sizes[i] for i in items) for b, items in self.bins.items()}
        self.least = -(-sum(sizes) // capacity)
        self.by_slack, self.by_item = defaultdict(set), defaultdict(lambda: defaultdict(set))
        for b in self.bins:
            self._enter(b)

    def _enter(self, b: int) -> None:
        slack = self.capacity - self.fill[b]
        if slack and self.bins[b]:
            self.by_slack[slack].add(b)
            for i in self.bins[b]:
                self.by_item[self.sizes[i]][slack].add(b)

    def _leave(self, b: int) -> None:
        slack = self.capacity - self.fill[b]
        if slack:
            self._drop(self.by_slack, slack, b)
            for s in {self.sizes[i] for i in self.bins[b]}:
                self._drop(self.by_item[s], slack, b)

    @staticmethod
    def _drop(index: dict, key: int, b: int) -> None:
        if key in index:
            index[key].discard(b)
            if not index[key]:
                del index[key]

    def _target(self, index: dict, need: int, light: int) -> int | None:
        """The fullest other bin with at least ``need`` free that is not lighter than ``light``."""
        for slack in sorted(s for s in index if s >= need):
            for b in sorted(index[slack]):
                if b != light and self.fill[b] >= self.fill[light]:
                    return b
        return None

    def _shift(self, light: int, out: list[int], target: int, back: list[int]) -> None:
        self._leave(light)
        self._leave(target)
        for i in out:
            self.bins[light].remove(i)
        for i in back:
            self.bins[target].remove(i)
        self.bins[light] += back
        self.bins[target] += out
        gain = sum(self.sizes[i] for i in out) - sum(self.sizes[i] for i in back)
        self.fill[light] -= gain
        self.fill[target] += gain
        self._enter(target)
        if self.bins[light]:
            self._enter(light)
        else:
            del self.bins[light], self.fill[light]

    def _step(self, light: int) -> bool:
        items = sorted(self.bins[light], key=lambda i: (-self.sizes[i], i))
        for i in items:
            if (b := self._target(self.by_slack, self.sizes[i], light)) is not None:
                self._shift(light, [i], b, [])
                return True
        most = max(self.by_slack, default=0)
        singles = [[i] for i in items]
        pairs = [[i, j] for n, i in enumerate(items[:24]) for j in items[n + 1 : 24]]
        for out in [*singles, *pairs]:
            size = sum(self.sizes[i] for i in out)
            for gain in range(min(most, size - 1), 0, -1):
                if (size - gain) in self.by_item and (b := self._target(self.by_item[size - gain], gain, light)) is not None:
                    self._shift(light, out, b, [next(i for i in self.bins[b] if self.sizes[i] == size - gain)])
                    return True
        return False

    def run(self, lightest: int = 16) -> list[list[int]]:
        stuck: set[int] = set()
        while len(self.bins) > self.least and len(stuck) < lightest:
            light = min((b for b in self.fill if b not in stuck and self.fill[b] < self.capacity), key=lambda b: (self.fill[b], b), default=None)
            if light is None:
                break
            moved = False
            while light in self.bins and self._step(light):
                moved = True
            if moved:  # what has changed may help the others
                stuck.clear()
            if light in self.bins:
                stuck.add(light)
        return list(self.bins.values())


def pack(table: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP) -> DataFrame:
    """``table`` (doc_id, piece, start, length, ...) with sequence_id and offset.

    Pieces are dealt by hash to groups of about ``group_rows`` (their number follows the input, so a
    group's memory does not); each group is packed on its own and wastes less than one sequence.
    """
    table = saved(table, "pieces")
    groups = max(1, -(-table.count() // group_rows))
    dealt = table.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "length", "ids_crc32"), F.lit(groups)))
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in table.schema.fields)}, sequence_id bigint, offset bigint"

    def run(group: pa.Table) -> pa.Table:
        number = group["_group"][0].as_py()
        group = group.drop_columns(["_group"]).sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        sizes = group["length"].to_pylist()
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for b, items in enumerate(LocalSearch(sizes, best_fit(sizes, capacity), capacity).run()):
            at = 0
            for i in items:
                sequence[i], offset[i] = (number << 32) + b, at
                at += sizes[i]
        return group.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("_group").applyInArrow(run, schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Documents as pieces in sequences of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are the end id alone; very long texts are cut as said in ``pieces``; null ids
    are kept; repeated rows are packed each; other columns are ignored; an empty table packs to nothing.
    """
    return pack(pieces(docs, id_col, text_col, path, capacity), capacity)
