"""SentencePiece (BPE with byte fallback): encoding by vectorised merge rounds, decoding by table.

A text is cut where no piece of the vocabulary can reach across: before the white space that begins a
word. All distinct words of a chunk become one flat array of symbols. Each round finds, per word, the
smallest rank among its neighbouring pairs and merges the leftmost such pair, in all words at once;
the array is compacted and words without a pair leave it. One merge a word and round keeps the order
in which the library merges, also where scores tie.
"""

from __future__ import annotations

import codecs
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightshare.llm.flat import chunks
from nightshare.llm.rounds import NONE, Lookup, MergeRounds, pair
from nightshare.llm.tokens import tokenizer_path

PIECE_BPE, SPACE = "piece_bpe_32k.model", "▁"
#: Symbols that are no piece: this plus the code point.
STRANGE = 1 << 24


class Pieces(MergeRounds):
    """The vocabulary of a model file as tables. Only BPE models with byte fallback, identity normalisation and a dummy prefix."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        byte = [i for i in range(n) if model.is_byte(i)]
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if len(byte) != 256:
            raise ValueError(f"{path} has no byte fallback")
        if any(SPACE in names[i].lstrip(SPACE) for i in plain):
            raise ValueError(f"{path} has pieces that reach across words")
        self.end, self.control = model.eos_id(), np.array([model.is_control(i) for i in range(n)])
        self.byte = np.zeros(256, np.int32)
        self.byte[[int(names[i][1:-1], 16) for i in byte]] = byte
        ids = {names[i]: i for i in plain}
        # Equal scores are equal ranks, so that the leftmost of them goes first.
        scores = np.array([model.get_score(i) for i in range(n)])
        self.rank = np.full(n, NONE, np.int32)
        self.rank[plain] = np.unique(-scores[plain], return_inverse=True)[1]
        symbol = lambda s: ids.get(s, STRANGE + ord(s) if len(s) == 1 else None)
        left, right, into = [], [], []
        for name, i in ids.items():
            for cut in range(1, len(name)):
                a, b = symbol(name[:cut]), symbol(name[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), into.append(i)
        self.pairs = Lookup(pair(np.array(left, np.int64), np.array(right, np.int64)), np.array(into, np.int32))
        close = np.unique([pair(ord(a), ord(b)) for name in ids for a, b in zip(name, name[1:])])
        self.close = Lookup(close, np.zeros(len(close), np.int32))
        self.symbol = np.arange(0x110000, dtype=np.int32) + STRANGE
        single = [(ord(name), i) for name, i in ids.items() if len(name) == 1]
        self.symbol[[c for c, _ in single]] = [i for _, i in single]
        shown = [names[i].replace(SPACE, " ").encode() for i in range(n)]
        for b, i in enumerate(self.byte):
            shown[i] = bytes([b])
        for i in range(n):
            if model.is_control(i):
                shown[i] = b""
            elif model.is_unknown(i):
                shown[i] = " ⁇ ".encode()
        self.shown = pa.array(shown, pa.binary())
        #: Ids whose leading space goes when they come first.
        self.spaced = np.array([names[i].startswith(SPACE) for i in range(n)])

    # --- encoding ------------------------------------------------------------------------

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text begins and the end); null and empty texts have none."""
        spaced = pc.replace_substring(texts.cast(pa.string()), SPACE, " ")
        filled = pc.fill_null(spaced, "")
        prefixed = pc.binary_join_element_wise(pc.if_else(pc.equal(filled, ""), "", " "), filled, "")
        raw = np.frombuffer("".join(prefixed.to_pylist()).encode(), np.uint8)
        lengths = pc.binary_length(prefixed).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        blank = raw == 32
        cut = blank.copy()
        cut[1:] &= ~blank[:-1]
        heads = (ends - lengths)[lengths > 0]
        cut[heads] = True
        starts = np.flatnonzero(cut)
        bounds = np.append(starts, len(raw)).astype(np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]).dictionary_encode()
        ids, offsets = self.encode_words(found.dictionary)
        per_word = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer((offsets * 4).astype(np.int32)), pa.py_buffer(ids)])
        spread = per_word.take(found.indices)
        buffers = spread.buffers()
        flat = np.frombuffer(buffers[2], np.int32) if len(starts) else np.zeros(0, np.int32)
        at = np.frombuffer(buffers[1], np.int32, len(spread) + 1) // 4 if len(starts) else np.zeros(1, np.int64)
        words_before = np.concatenate([[0], np.searchsorted(starts, ends)])
        return flat[: at[-1]], at[words_before].astype(np.int64)

    def encode_words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, where each begins and the end)."""
        buffers = distinct.buffers()
        bounds = np.frombuffer(buffers[1], np.int32, len(distinct) + 1) if len(distinct) else np.zeros(1, np.int32)
        raw = np.frombuffer(buffers[2], np.uint8)[bounds[0] : bounds[-1]] if len(distinct) else np.zeros(0, np.uint8)
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(len(distinct) + 1, np.int64)
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        points[points == 32] = ord(SPACE)
        chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[bounds - bounds[0]]
        begins = np.zeros(len(points), bool)
        begins[chars[:-1]] = True
        # No piece holds these two letters side by side, so what stands on either side merges on its own.
        begins[1:] |= self.close.get(pair(points[:-1], points[1:])) < 0
        parts = np.append(np.flatnonzero(begins), len(points))
        symbols, part = self.merge(self.symbol[points], parts)
        word = np.searchsorted(chars, parts[:-1], side="right")[part] - 1
        ids, of = self.with_bytes(symbols, word)
        return ids, np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(distinct)))]).astype(np.int64)

    def with_bytes(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols that are no piece become the ids of their bytes."""
        strange = symbols >= STRANGE
        if not strange.any():
            return symbols, owner
        count = np.ones(len(symbols), np.int64)
        point = symbols[strange] - STRANGE
        count[strange] = 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)
        out = np.repeat(symbols, count)
        raw = np.frombuffer(point.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)
        out[np.repeat(strange, count)] = self.byte[raw]
        return out, np.repeat(owner, count)

    # --- decoding ------------------------------------------------------------------------

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of id sequences: pieces joined, the first one's leading space dropped, bytes that make no letter as U+FFFD."""
        spread = self.shown.take(pa.array(ids))
        bounds = np.frombuffer(spread.buffers()[1], np.int32, len(ids) + 1) if len(ids) else np.zeros(1, np.int32)
        data = memoryview(spread.buffers()[2] or b"") if len(ids) else memoryview(b"")
        shown = np.concatenate([[0], np.cumsum(~self.control[ids])])
        # The first id of each sequence that shows anything.
        firsts = np.searchsorted(shown, shown[offsets[:-1]], side="right") - 1
        texts = []
        for a, b, first in zip(offsets[:-1].tolist(), offsets[1:].tolist(), firsts.tolist()):
            drop = first < b and bool(self.spaced[ids[first]])
            begin, stops = bounds[a] + drop, [b]
            if b > a and shown[b - 1] - shown[a] < b - 1 - a:  # bytes do not join across control ids inside
                stops = [*(a + np.flatnonzero(self.control[ids[a:b]])).tolist(), b]
            parts = []
            for stop in stops:
                parts.append(bytes(data[begin : bounds[stop]]).decode("utf-8", "each_byte"))
                begin = max(begin, bounds[stop])
            texts.append("".join(parts))
        return texts


codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


def pieces(path: str) -> Pieces:
    """One vocabulary per worker process and file, kept between tasks."""
    held = vars(sys.modules.setdefault("_nightshare_pieces", types.ModuleType("_nightshare_pieces")))
    if path not in held:
        held[path] = Pieces(path)
    return held[path]


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    names = [n for n in batch.schema.names if n not in columns]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], *columns.values()], names=[*names, *columns])


def _schema(df: DataFrame, **columns: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema if f.name not in columns] + [T.StructField(n, t) for n, t in columns.items()])


def _ended(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    return np.insert(ids, offsets[1:], end).astype(np.int32), offsets + np.arange(len(offsets))


def encode(df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, decoded: str | None = None) -> DataFrame:
    """Add the ids of each whole text, with the end id last, and on request the text that these ids decode to.

    All rows and columns stay, a column named like an output is replaced. A null text is an empty
    one: its ids are the end id alone. Texts of any length are read whole; a task holds a chunk of
    texts at a time, or one longer text. Repeated rows stay repeated; an empty table gives no rows.
    """
    path = path or tokenizer_path(PIECE_BPE)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            for part in chunks(batch, text):
                ids, offsets = _ended(*vocabulary.encode(part.column(text)), vocabulary.end)
                columns = {out: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))}
                if decoded:
                    columns[decoded] = pa.array(vocabulary.decode(ids, offsets), pa.string())
                yield _with(part, **columns)

    more = {out: T.ArrayType(T.IntegerType())} | ({decoded: T.StringType()} if decoded else {})
    return df.mapInArrow(task, _schema(df, **more))


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """Add the text of each id sequence, as the library's ``decode``; null for a null sequence.

    All rows and columns stay, a column named like the output is replaced. Ids outside the
    vocabulary, and nulls among the ids, are an error.
    """
    path = path or tokenizer_path(PIECE_BPE)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for batch in batches:
            column = batch.column(ids)
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            flat = column.flatten()
            if flat.null_count:
                raise ValueError(f"{ids} holds nulls inside its sequences")
            texts = vocabulary.decode(flat.to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))
            yield _with(batch, **{out: pa.array(texts, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))})

    return df.mapInArrow(task, _schema(df, **{out: T.StringType()}))


def piece_digests(docs: DataFrame) -> DataFrame:
    """Per row doc_id, number of ids, and the digests of the ids and of the text that they decode to."""
    rows = encode(docs.select("doc_id", "text"), decoded="decoded")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
