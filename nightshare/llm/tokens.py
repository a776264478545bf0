"""Token ids of whole texts, with a bounded cache of encoded words."""

from __future__ import annotations

import json
import re
import sys
import types
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from nightshare.llm import flat
from nightshare.llm.rounds import NONE, Lookup, MergeRounds, pair

BYTE_BPE, WORD_BPE, CACHE = "byte_bpe_50k.json", "word_bpe_49k.json", 300_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Texts with other characters, two white spaces in a row, or a letter after an apostrophe go to the library whole.
_UNUSUAL = re.compile(rf"[^\n -~{_LETTERS}]|\s\s|'[{_LETTERS}]")
#: The same for the texts of a column at once; a white space in a usual text is a space or a line break.
_UNUSUAL_RE2 = rf"[^\n -~{_LETTERS}]|[\n ][\n ]|'[{_LETTERS}]"
#: Letters of usual texts by byte.
_LETTER = np.array([chr(b).isascii() and chr(b).isalpha() or b >= 0x80 for b in range(256)])
_PIECES = re.compile(rf" ?[{_LETTERS}]+|(?:[^{_LETTERS} ]| (?![{_LETTERS}]))+")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """Byte -> its printable letter in byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256 on."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return {b: chr(b if b in kept else next(spare)) for b in range(256)}


class Kept(dict):
    """Values by key, made where they are missing; at most ``size`` are held, in a newer and an older half of which the older goes."""

    def __init__(self, size: int, make: Callable[[str], bytes]):
        self.half, self.make, self.before = max(1, size // 2), make, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.half:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class Vocabulary(MergeRounds):
    """The merges of a byte-level model of the tokenizers library as tables."""

    def __init__(self, model: dict, letters: dict[int, str]):
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right, into = (np.array([vocab[x] for x in part], np.int64) for part in (*zip(*merges), [a.removesuffix(suffix) + b if suffix else a + b for a, b in merges]))
        if len(np.unique(into)) < len(into):
            raise ValueError("two merges make the same token")
        self.rank = np.full(int(max(vocab.values())) + 1, NONE, np.int32)
        self.rank[into] = np.arange(len(into))
        self.pairs = Lookup(pair(left, right), into.astype(np.int32))
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int32)

    def encode(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, where each begins and the end) of words as flat bytes; no word is empty."""
        symbols = self.inner[raw]
        symbols[bounds[1:] - 1] = self.last[raw[bounds[1:] - 1]]
        ids, owner = self.merge(symbols, bounds)
        return ids, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(bounds) - 1))])


class Encoder:
    """Ids as the tokenizers library gives them without special tokens; special strings are ordinary text.

    A run of letters, in the byte vocabulary with the one space before it, is a piece that
    both vocabularies merge on its own. In usual texts such pieces go to the library's merge
    model once each and what stands between them to the whole library once each; other texts
    go to the library whole. Words between spaces are kept as well, with their ids; both caches
    hold ``cache`` words at most, so memory is bounded, and frequent words stay.
    """

    def __init__(self, path: str, cache: int = CACHE):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.merge = self.library.model.tokenize
        self.words_only = self.library.encode("a b", add_special_tokens=False).ids == self.library.encode("A  B", add_special_tokens=False).ids
        self.letters = _byte_letters()
        self.rounds = Vocabulary(json.loads(self.library.to_str())["model"], self.letters)
        self.pieces = Kept(cache, self.piece)
        self.known = Kept(cache, self.word)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def piece(self, piece: str) -> bytes:
        if not piece[-1].isalpha():
            return self.whole(piece).tobytes()
        if self.words_only:
            piece = piece.lstrip(" ").lower()
        mapped = piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.merge(mapped)]).tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if _UNUSUAL.search(text):
            return self.whole(text)
        first, *rest = text.split(" ")
        return np.frombuffer(b"".join([self.joined(first), *map(self.known.__getitem__, rest)]), np.uint32)

    def encode_all(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a column in turn, a chunk of texts at a time; every distinct word of a chunk is looked up once."""
        for part in flat.chunks(pa.RecordBatch.from_arrays([texts.cast(pa.string())], names=["text"]), "text"):
            column = part.column(0)
            usual = pc.invert(pc.fill_null(pc.match_substring_regex(column, _UNUSUAL_RE2), False))
            ids, bounds = self.by_words(column.filter(usual))
            turn = iter(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
            for i, plain in enumerate(usual.to_pylist()):
                if plain:
                    a, b = next(turn)
                    yield ids[a:b]
                else:
                    yield self.whole(column[i].as_py())

    def by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of usual texts in a row, where each text begins and the end).

        In usual texts the bytes beyond ASCII are letters. A run of letters with the space before it is a
        piece, and so is what stands between two of them. Of the distinct pieces the runs of letters
        merge in rounds all at once, the few others go to the library.
        """
        raw, bounds = flat.text_bytes(texts), flat.text_offsets(texts)
        if not len(raw):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        letter = _LETTER[raw]
        heads = bounds[:-1][np.diff(bounds) > 0]
        lead = raw == 32
        lead[:-1] &= letter[1:]
        lead[-1] = False
        lead[heads[1:] - 1] = False  # a space that ends a text leads no letters of the next
        run = letter | lead
        begins = lead.copy()
        begins[1:] |= run[1:] != run[:-1]
        begins[heads] = True
        starts = np.flatnonzero(begins)
        edges = np.append(starts, len(raw)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edges), pa.py_buffer(raw)]).dictionary_encode()
        spread = self.of_pieces(coded.dictionary).take(coded.indices)
        buffers = spread.buffers()
        at = np.frombuffer(buffers[1], np.int32, len(spread) + 1) // 4
        return np.frombuffer(buffers[2], np.uint32, int(at[-1])) if at[-1] else np.zeros(0, np.uint32), at[np.searchsorted(starts, bounds)].astype(np.int64)

    def of_pieces(self, distinct: pa.Array) -> pa.Array:
        """Ids of distinct pieces, each as the bytes of 32-bit numbers."""
        bounds = np.frombuffer(distinct.buffers()[1], np.int32, len(distinct) + 1).astype(np.int64)
        raw = np.frombuffer(distinct.buffers()[2], np.uint8)[: bounds[-1]]
        runs = _LETTER[raw[bounds[1:] - 1]]
        keep = np.repeat(runs, np.diff(bounds))
        sizes = np.diff(bounds)[runs]
        if self.words_only:  # without the space, in lower case
            keep[bounds[:-1][runs & (raw[bounds[:-1]] == 32)]] = False
            sizes = sizes - (raw[bounds[:-1]][runs] == 32)
            accented = np.concatenate([[False], raw[:-1] == 0xC3]) & (raw >= 0x80) & (raw <= 0x9E) & (raw != 0x97)
            raw = np.where(accented, raw + 32, flat.LOWER[raw]).astype(np.uint8)
        ids, ends = self.rounds.encode(raw[keep], np.concatenate([[0], np.cumsum(sizes)]))
        merged = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer((4 * ends).astype(np.int32)), pa.py_buffer(ids.astype(np.uint32))])
        others = pa.array([self.pieces[p] for p in distinct.filter(pa.array(~runs)).cast(pa.string()).to_pylist()], pa.binary())
        turn = np.where(runs, np.cumsum(runs) - 1, len(sizes) + np.cumsum(~runs) - 1)
        return pa.concat_arrays([merged, others]).take(pa.array(turn))

    def word(self, word: str) -> bytes:
        return self.piece(" " + word) if word.isalpha() else self.joined(" " + word)

    def joined(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _PIECES.findall(text)))


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file, kept between tasks (task code itself is loaded anew for each)."""
    held = vars(sys.modules.setdefault("_nightshare_encoders", types.ModuleType("_nightshare_encoders")))
    if path not in held:
        held[path] = Encoder(path)
    return held[path]
