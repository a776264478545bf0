"""Landed files opened by tasks: CSV by column name whatever the layout, heads and digests, JSON arrays cut into ranges.

The Python data sources here list the files below the given paths (names and sizes, as Spark's own file index
does) and deal them out by size; contents are only ever read by tasks, in pieces of bounded size.
"""

from __future__ import annotations

import codecs
import csv
import gzip
import hashlib
import io
import json
import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyarrow import csv as arrow_csv
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Task code is shipped by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a group of files or of a range; bytes read at once; bytes of a block of CSV rows (a single row has to fit).
GROUP, PIECE, BLOCK = 64 << 20, 4 << 20, 16 << 20
#: Bytes of JSON whose quotes and brackets are found at once: the arrays for it take some fifty times as much.
MARKED = 128 << 10


def _open(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _packed(path: str) -> bool:
    return path.endswith((".gz", ".gzip"))


def _pieces(path: str, start: int = 0) -> Iterator[bytes]:
    """The bytes of a file from ``start`` on, unpacked, piece by piece."""
    with _open(path) as raw:
        stream = gzip.GzipFile(fileobj=raw) if _packed(path) else raw
        stream.seek(start)
        while piece := stream.read(PIECE):
            yield piece


def listing(paths: Sequence[str]) -> list[tuple[str, int]]:
    """(path, bytes) of all files at or below the paths; hidden and marker files are left out."""
    out = []
    for path in paths:
        path = path.rstrip("/")
        system, place = fs.FileSystem.from_uri(path)
        head = path[: len(path) - len(place)] if path.endswith(place) else path.split(":", 1)[0] + "://"
        info = system.get_file_info(place)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
        hidden = lambda name: any(x.startswith(("_", ".")) for x in name.split("/"))
        out += [(head + f.path, f.size) for f in found if f.type == fs.FileType.File and (f is info or not hidden(f.path[len(place) :].lstrip("/")))]
    return sorted(out)


def grouped(files: list[tuple[str, int]], most: int = GROUP) -> list[list[str]]:
    """Files side by side in groups of at most ``most`` bytes, a larger one alone."""
    out, size = [], 0
    for path, n in sorted(files, key=lambda f: -f[1]):
        if not out or size + n > most:
            out.append([])
            size = 0
        out[-1].append(path)
        size += n
    return out


class Files(InputPartition):
    def __init__(self, parts: list[tuple[str, int, int | None]]):
        super().__init__(None)
        #: (path, first byte, byte after the last or None for the end of the file)
        self.parts = parts


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        # Spark's option names are not case-sensitive; values are JSON texts.
        self.options = {k.lower(): v for k, v in options.items()}
        self.paths = json.loads(self.options["paths"])
        self.most = int(self.options.get("group", GROUP))

    def partitions(self) -> list[Files]:
        found = [Files([(p, 0, None) for p in group]) for group in grouped(listing(self.paths), self.most)]
        return found or [Files([])]


class HeadReader(_Reader):
    """Path, bytes and first line; with ``digest`` also the number of lines and the SHA-256 of the raw bytes."""

    def read(self, partition: Files) -> Iterator[tuple]:
        whole = self.options.get("digest") == "true"
        for path, _, _ in partition.parts:
            header, lines, last = b"", 0, b"\n"
            for piece in _pieces(path):
                if not lines:
                    header += piece.split(b"\n", 1)[0]
                lines += piece.count(b"\n")
                last = piece[-1:]
                if lines and not whole:
                    break
            digest = hashlib.sha256()
            size = 0
            with _open(path) as raw:
                size = raw.size()
                while whole and (piece := raw.read(PIECE)):
                    digest.update(piece)
            header = header.removeprefix(codecs.BOM_UTF8).rstrip(b"\r").decode("utf-8", "replace")
            yield path, size, header, lines + (last != b"\n") if whole else None, digest.hexdigest() if whole else None


class FileHeads(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_heads"

    def schema(self) -> str:
        return "path string, bytes long, header string, lines long, sha256 string"

    def reader(self, schema: T.StructType) -> HeadReader:
        return HeadReader(self.options)


class NamedCsvReader(_Reader):
    """Rows of CSV files, columns found by name in each file's own header; see :func:`read_named_csv`."""

    def __init__(self, options: dict):
        super().__init__(options)
        self.columns, self.rest = json.loads(self.options["columns"]), self.options.get("rest")
        self.sep, self.encoding, self.quoted = self.options["sep"], self.options["encoding"], self.options["quoted"] == "true"

    def partitions(self) -> list[Files]:
        files = listing(self.paths)
        if self.quoted:  # a quote may hold line breaks, so only the start of a file is a safe place to begin
            return super().partitions()
        ranges, small = [], []
        for path, size in files:
            if _packed(path) or size <= self.most:
                small.append((path, size))
            else:
                ranges += [Files([(path, at, min(size, at + self.most))]) for at in range(0, size, self.most)]
        return ranges + [Files([(p, 0, None) for p in group]) for group in grouped(small, self.most)] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path, start, end in partition.parts:
            names = self.header(path)
            if names:
                for batch in self.rows(path, start, end, names):
                    yield self.shaped(batch, path)

    def header(self, path: str) -> list[str]:
        head = b""
        for piece in _pieces(path):
            head += piece
            # The header ends at the first line break outside quotes.
            for m in re.finditer(rb"\n", head):
                if head[: m.start()].count(b'"') % 2 == 0:
                    head = head[: m.start()]
                    break
            else:
                continue
            break
        text = head.removeprefix(codecs.BOM_UTF8).decode(self.encoding, "replace").strip("\r\n")
        return next(csv.reader(io.StringIO(text), delimiter=self.sep), [])

    def rows(self, path: str, start: int, end: int | None, names: list[str]) -> Iterator[pa.RecordBatch]:
        wanted = [n for n in dict.fromkeys(names) if n in self.columns or (self.rest and re.search(self.rest, n))]
        read = arrow_csv.ReadOptions(use_threads=False, block_size=BLOCK, encoding=self.encoding, column_names=names, skip_rows=0)
        parse = arrow_csv.ParseOptions(delimiter=self.sep, newlines_in_values=self.quoted, ignore_empty_lines=True)
        convert = arrow_csv.ConvertOptions(
            column_types={n: pa.string() for n in names}, include_columns=wanted or names[:1], null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=False
        )
        stream = Lines(path, start, end)
        if start == 0:
            stream.skip_header()
        if stream.at_end():
            return
        with arrow_csv.open_csv(pa.PythonFile(stream, mode="r"), read, parse, convert) as batches:
            yield from batches

    def shaped(self, batch: pa.RecordBatch, path: str) -> pa.RecordBatch:
        n = len(batch)
        have = dict(zip(batch.schema.names, batch.columns))
        out = [have.get(c, pa.nulls(n, pa.string())) for c in self.columns]
        names = [*self.columns, "file"]
        out.append(pa.array([path] * n, pa.string()))
        if self.rest:
            cells = [c for c in have if c not in self.columns and re.search(self.rest, c)]
            turn = pa.array(np.arange(len(cells) * n).reshape(len(cells), n).T.ravel())
            items = pa.concat_arrays([have[c] for c in cells]).take(turn) if cells else pa.array([], pa.string())
            out.append(pa.MapArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(cells)), pa.array(cells * n, pa.string()), items))
            names.append("cells")
        return pa.RecordBatch.from_arrays(out, names=names)


class Lines(io.RawIOBase):
    """The whole lines of a file that begin in [start, end), as a stream; the last may end beyond."""

    def __init__(self, path: str, start: int, end: int | None):
        self.raw = _open(path)
        self.stream = gzip.GzipFile(fileobj=self.raw) if _packed(path) else self.raw
        self.at, self.end, self.held, self.done = start, end, b"", False
        if start:
            # A line that begins right at ``start`` is found by the break before it.
            self.stream.seek(start - 1)
            self.at = start - 1
            self._drop_line()

    def _fill(self) -> bool:
        if self.done:
            return False
        piece = self.stream.read(PIECE)
        if not piece:
            self.done = True
        elif self.end is not None and self.at + len(piece) >= self.end:
            # Up to the first break at or after the last byte of the range.
            cut = piece.find(b"\n", max(0, self.end - 1 - self.at))
            if cut >= 0:
                piece, self.done = piece[: cut + 1], True
        self.at += len(piece)
        self.held += piece
        return bool(piece)

    def _drop_line(self) -> None:
        while (cut := self.held.find(b"\n")) < 0:
            self.held = b""
            if not self._fill():
                return
        self.held = self.held[cut + 1 :]

    def skip_header(self) -> None:
        quotes = 0
        while self.held or self._fill():
            cut = self.held.find(b"\n")
            quotes += self.held[: cut if cut >= 0 else None].count(b'"')
            self.held = self.held[cut + 1 :] if cut >= 0 else b""
            if cut >= 0 and quotes % 2 == 0:
                return

    def at_end(self) -> bool:
        while not self.held:
            if not self._fill():
                return True
        return False

    def readable(self) -> bool:
        return True

    def read(self, n: int = -1) -> bytes:
        while (n < 0 or len(self.held) < n) and self._fill():
            pass
        out, self.held = (self.held, b"") if n < 0 else (self.held[:n], self.held[n:])
        return out

    def close(self) -> None:
        if not self.closed:
            self.raw.close()
        super().close()


class NamedCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_csv"

    def schema(self) -> T.StructType:
        options = {k.lower(): v for k, v in self.options.items()}
        fields = [T.StructField(c, T.StringType()) for c in [*json.loads(options["columns"]), "file"]]
        return T.StructType(fields + ([T.StructField("cells", T.MapType(T.StringType(), T.StringType()))] if options.get("rest") else []))

    def reader(self, schema: T.StructType) -> NamedCsvReader:
        return NamedCsvReader(self.options)


def _source(spark: SparkSession, kind: type[DataSource], path: str | Sequence[str], **options: str) -> DataFrame:
    spark.dataSource.register(kind)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format(kind.name()).options(paths=json.dumps(paths), **options).load()


def file_heads(spark: SparkSession, path: str | Sequence[str], digest: bool = False) -> DataFrame:
    """path, bytes and header of every file at or below ``path``; with ``digest`` also lines and sha256 (else null).

    Without ``digest`` a task reads the first piece of a file only; with it, the file in pieces, whatever
    its size. Lines and header are those of the unpacked text, bytes and digest those of the file.
    """
    return _source(spark, FileHeads, path, digest=str(digest).lower())


def read_named_csv(
    spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], quoted: bool = False, sep: str = ",", encoding: str = "utf-8", rest: str | None = None, group: int = GROUP
) -> DataFrame:
    """CSV files of different layouts together: ``columns`` by each file's own header, all text, and ``file``.

    A column that a file lacks is null there, as is an empty cell; a quoted empty cell is an empty text.
    ``quoted`` allows line breaks inside quotes, and then one task reads a whole file; otherwise large plain files are read in ranges
    of ``group`` bytes. ``rest`` is a pattern of further columns, given as the map ``cells`` by their names.
    Empty files have no rows; a row with more or fewer cells than its header is an error.
    """
    more = {"rest": rest} if rest else {}
    return _source(spark, NamedCsv, path, columns=json.dumps(list(columns)), quoted=str(quoted).lower(), sep=sep, encoding=encoding, group=str(group), **more)


# --- JSON arrays ---------------------------------------------------------------------------


class RangeReader(_Reader):
    """Ranges of JSON files with what a scan from left to right needs to know of each."""

    def partitions(self) -> list[Files]:
        files = listing(self.paths)
        whole = [Files([(p, 0, None)]) for p, _ in files if _packed(p)]
        cut = [Files([(p, at, min(n, at + self.most))]) for p, n in files if not _packed(p) for at in range(0, n, self.most)]
        return whole + cut or [Files([])]

    def read(self, partition: Files) -> Iterator[tuple]:
        for path, start, end in partition.parts:
            quotes, outside, inside = 0, 0, 0
            if end is not None:
                for _, quote, step in _marked(path, start, end):
                    odd = (np.cumsum(quote) + quotes) % 2 == 1
                    outside, inside = outside + int(step[~odd].sum()), inside + int(step[odd].sum())
                    quotes += int(quote.sum())
            yield path, start, end, quotes, outside, inside


class JsonRanges(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_ranges"

    def schema(self) -> str:
        return "path string, start long, end long, quotes long, if_outside long, if_inside long"

    def reader(self, schema: T.StructType) -> RangeReader:
        return RangeReader(self.options)


def _slashes(path: str, start: int) -> int:
    """How many backslashes stand right before a byte of a file."""
    with _open(path) as raw:
        back = 0
        while start - back > 0:
            raw.seek(start - back - 1)
            if raw.read(1) != b"\\":
                break
            back += 1
        return back


def _marked(path: str, start: int, end: int | None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """The bytes of a range with their marks (see :func:`json_marks`), ``MARKED`` at a time, however long the range."""
    before = _slashes(path, start) if start else 0
    for piece in _pieces(path, start):
        if end is not None:
            piece = piece[: max(0, end - start)]
        start += len(piece)
        for at in range(0, len(piece), MARKED):
            part = piece[at : at + MARKED]
            yield part, *json_marks(np.frombuffer(part, np.uint8), before)
            tail = len(part) - len(part.rstrip(b"\\"))
            before = before + tail if tail == len(part) else tail
        if start == end:
            return


def json_marks(data: np.ndarray, before: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(quotes that open or close a text, +1 or -1 at brackets) by byte; brackets inside texts are marked too."""
    slash = data == 0x5C
    # Length of the run of backslashes that ends before each byte.
    at = np.arange(len(data))
    other = np.maximum.accumulate(np.where(slash, -1, at))
    run = np.where(other >= 0, at - other, at + 1 + before)
    run = np.concatenate([[before], np.where(slash, run, 0)[:-1]]) if len(data) else run
    quote = (data == 0x22) & (run % 2 == 0)
    step = ((data == 0x7B) | (data == 0x5B)).astype(np.int8) - ((data == 0x7D) | (data == 0x5D)).astype(np.int8)
    return quote, step


def objects_of(path: str, start: int, end: int | None, in_text: bool, depth: int) -> Iterator[str]:
    """The elements (objects) that begin in a range of a JSON array, or of a file of objects one after the other."""
    level = 0
    for piece in _pieces(path):
        if first := piece.lstrip(b"\xef\xbb\xbf \t\r\n")[:1]:
            level = 1 if first == b"[" else 0
            break
    held, base, begun = bytearray(), start, None
    for piece, quote, step in _marked(path, start, None):
        data = np.frombuffer(piece, np.uint8)
        inside = (np.cumsum(quote) + in_text) % 2 == 1
        step = np.where(inside, 0, step)
        depths = depth + np.cumsum(step, dtype=np.int64)
        spots = np.flatnonzero(((data == 0x7B) & (step == 1) & (depths == level + 1)) | ((data == 0x7D) & (step == -1) & (depths == level)))
        held += piece
        for spot in spots.tolist():
            place = base + spot
            if data[spot] == 0x7B:
                if end is not None and place >= end:
                    return
                begun = place
            elif begun is not None:
                yield held[begun - (base + len(piece) - len(held)) : place + 1 - (base + len(piece) - len(held))].decode("utf-8", "replace")
                begun = None
                if end is not None and place + 1 >= end:
                    return
        in_text = bool(inside[-1]) if len(inside) else in_text
        # A quote is counted as inside from its opening on, and its closing quote as outside.
        depth = int(depths[-1]) if len(depths) else depth
        base += len(piece)
        del held[: len(held) if begun is None else begun - (base - len(held))]
        if end is not None and base >= end and begun is None:
            return


def read_json_objects(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, group: int = GROUP) -> DataFrame:
    """Rows of the objects of JSON arrays, one large file over many tasks.

    A first pass over the ranges counts quotes and brackets; running totals then say for each range
    whether it begins inside a text and how deep; a second pass cuts out the objects that begin in it.
    A packed file is read by one task. Elements that are no objects are left out; absent fields are null.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ranges = _source(spark, JsonRanges, path, group=str(group))
    # One row a range, so a window over a file has a row for each of its 64 MB.
    known = ranges.withColumn("in_text", F.coalesce(F.sum("quotes").over(w), F.lit(0)) % 2 == 1)
    known = known.withColumn("change", F.when(F.col("in_text"), F.col("if_inside")).otherwise(F.col("if_outside")))
    known = known.withColumn("depth", F.coalesce(F.sum("change").over(w), F.lit(0))).select("path", "start", "end", "in_text", "depth")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                texts: list[str] = []
                size = 0
                for text in objects_of(r["path"], r["start"], r["end"], r["in_text"], r["depth"]):
                    texts.append(text)
                    size += len(text)
                    if size >= PIECE:
                        yield pa.RecordBatch.from_arrays([pa.array(texts)], names=["value"])
                        texts, size = [], 0
                if texts:
                    yield pa.RecordBatch.from_arrays([pa.array(texts)], names=["value"])

    # The ranges of one file lie side by side after the window; they are dealt out anew.
    texts = known.repartition("path", "start").mapInArrow(task, "value string")
    return texts.select(F.from_json("value", schema).alias("v")).select("v.*")
