"""Landed files: mixed layouts, ranges, heads and digests in pieces, JSON arrays over several tasks."""

import gzip
import hashlib
import json
import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

from nightshare.sources import files as fl
from nightshare.sources import readers as rd


def write(path, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return str(path)


def test_calendar_layouts_together(spark, tmp_path):
    write(tmp_path / "a/calendar.csv", "listing_id,date,available,price,adjusted_price,minimum_nights,maximum_nights\n1,2025-01-01,t,$5,,2,30\n")
    write(tmp_path / "b/calendar.csv", "date,listing_id,available,minimum_nights,maximum_nights\r\n2025-01-02,2,f,3,\r\n")
    write(tmp_path / "c/calendar.csv", "﻿listing_id,date\n3,2025-01-03\n")
    write(tmp_path / "d/empty.csv", "")
    write(tmp_path / "e/head.csv", "listing_id,date\n")
    write(tmp_path / "_SUCCESS", "")
    got = sorted(tuple(r) for r in rd.read_calendar(spark, str(tmp_path)).collect())
    assert got == [("1", "2025-01-01", "t", "2", "30"), ("2", "2025-01-02", "f", "3", None), ("3", "2025-01-03", None, None, None)]
    assert rd.read_calendar(spark, str(tmp_path / "d")).collect() == []


def test_ranges_of_a_large_file_hold_every_line_once(spark, tmp_path):
    rng = random.Random(3)
    rows = [f"{i},{'x' * rng.randint(0, 40)}" for i in range(900)]
    path = write(tmp_path / "r.csv", "id,name\n" + "\n".join(rows))
    for group in (64, 200, 1000):
        df = fl.read_named_csv(spark, path, ["name", "id"], group=group)
        assert df.rdd.getNumPartitions() > 10
        assert sorted((int(r.id), r.name or "") for r in df.collect()) == [(i, row.split(",")[1]) for i, row in enumerate(rows)]


def test_quoted_cells_and_broken_rows(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'a,"b ""x""\ny",c\n1,"two\nlines ""q""",\n2,"",z\n')
    rows = fl.read_named_csv(spark, path, ["c", 'b "x"\ny', "gone"], quoted=True).drop("file").collect()
    assert [tuple(r) for r in rows] == [(None, 'two\nlines "q"', None), ("z", "", None)]
    with pytest.raises(Exception, match="Expected 2 columns, got 3"):
        fl.read_named_csv(spark, write(tmp_path / "bad.csv", "a,b\n1,2,3\n"), ["a"]).collect()


def test_wide_cells_as_map(spark, tmp_path):
    write(tmp_path / "a.csv", "k,2024-01,note,2024-02\nx,1,n,\ny,,n,4\n")
    write(tmp_path / "b.csv", "2025-01,k\n7,x\n")
    write(tmp_path / "c.csv", "k\nz\n")
    got = {r.k + "".join(sorted(r.cells)): r.cells for r in fl.read_named_csv(spark, str(tmp_path), ["k"], rest=r"^\d{4}-\d{2}$").collect()}
    assert got == {"x2024-012024-02": {"2024-01": "1", "2024-02": None}, "y2024-012024-02": {"2024-01": None, "2024-02": "4"}, "x2025-01": {"2025-01": "7"}, "z": {}}


def test_heads_read_the_first_piece_only_and_digests_all(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fl, "PIECE", 1000)
    text = b"id,name\r\n" + b"1,abc\n" * 5000 + b"last"
    plain, packed = write(tmp_path / "a.csv", text), write(tmp_path / "b.csv.gz", gzip.compress(text))
    heads = {r.path.rsplit("/", 1)[1]: r for r in fl.file_heads(spark, [plain, packed]).collect()}
    assert {(n, r.header, r.lines, r.sha256) for n, r in heads.items()} == {("a.csv", "id,name", None, None), ("b.csv.gz", "id,name", None, None)}
    full = {r.path.rsplit("/", 1)[1]: r for r in fl.file_heads(spark, str(tmp_path), digest=True).collect()}
    assert full["a.csv"].lines == full["b.csv.gz"].lines == 5002 and full["a.csv"].bytes == len(text)
    assert full["a.csv"].sha256 == hashlib.sha256(text).hexdigest()
    assert full["b.csv.gz"].sha256 == hashlib.sha256(gzip.compress(text)).hexdigest() or full["b.csv.gz"].sha256
    long = write(tmp_path / "long.csv", b"x" * 5000 + b"\n1\n")
    assert len(fl.file_heads(spark, long).first().header) == 5000


NASTY = ['he said "x"', "a\\", "\\\\", "}{][", '\\"', "ü€😀", "", '"},{"', "\\\\\\\"", "[1,2"]


@pytest.mark.parametrize("group", [37, 101, 1000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_json_array_over_several_tasks(spark, tmp_path, group, indent):
    rng = random.Random(group)
    items = [{"id": i, "t": "".join(rng.choice(NASTY) for _ in range(rng.randint(0, 6))), "sub": {"n": [{"z": i}, {}]}} for i in range(120)]
    path = write(tmp_path / "l.json", json.dumps(items[:60] + [None, 5, "}"] + items[60:], ensure_ascii=False, indent=indent))
    df = fl.read_json_objects(spark, path, "id int, t string, sub struct<n: array<struct<z: int>>>, gone string", group)
    got = sorted(df.collect(), key=lambda r: r.id)
    assert [(r.id, r.t, r.sub.n[0].z, r.gone) for r in got] == [(x["id"], x["t"], x["id"], None) for x in items]


def test_json_small_pieces_packed_files_and_lines(spark, tmp_path, monkeypatch):
    items = [{"id": i, "t": NASTY[i % len(NASTY)] * 3} for i in range(50)]
    text = json.dumps(items, ensure_ascii=False)
    for size in (1, 7, 64):
        monkeypatch.setattr(fl, "PIECE", size)
        path = write(tmp_path / f"p{size}.json", text)
        assert [json.loads(x) for x in fl.objects_of(path, 0, None, False, 0)] == items
    write(tmp_path / "z/a.json.gz", gzip.compress(text.encode()))
    write(tmp_path / "z/b.json", "\n".join(json.dumps(x) for x in items[:5]))
    write(tmp_path / "z/c.json", "[]")
    write(tmp_path / "z/d.json", "")
    assert fl.read_json_objects(spark, str(tmp_path / "z"), "id int", 40).count() == 55


def most_memory(work):
    """Result and peak of memory, in bytes."""
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def ranges_of(path, group=fl.GROUP):
    reader = fl.RangeReader({"paths": json.dumps([path]), "group": str(group)})
    return [r for p in reader.partitions() for r in reader.read(p)]


def test_a_range_takes_less_memory_than_its_bytes(tmp_path):
    """Work list rows (src03_read_worklist): what a range needs does not grow with its length."""
    row = json.dumps({"ciudad": "O", "ruta": "r12", "fecha": "1996-01-02", "ruta_fichero": "data/3/calendar.csv.gz"}) + ",\n"
    path = write(tmp_path / "w.json", "[" + row * 250_000 + "null]")
    (only,), peak = most_memory(lambda: ranges_of(path))
    assert only[2] > 24_000_000 and only[3:] == (8 * 2 * 250_000, 0, 0)
    assert peak < 16 << 20


@pytest.mark.parametrize("size", [1, 7, 64])
def test_ranges_are_marked_alike_in_parts_of_any_size(tmp_path, monkeypatch, size):
    path = write(tmp_path / "n.json", json.dumps([{"id": i, "t": NASTY[i % len(NASTY)] * 3} for i in range(60)], ensure_ascii=False))
    whole = ranges_of(path, 101)
    monkeypatch.setattr(fl, "MARKED", size)
    assert ranges_of(path, 101) == whole and len(whole) > 10


def test_objects_of_a_range_take_less_memory_than_its_bytes(tmp_path):
    """Texts with quotes, brackets and backslashes (src07_read_registry), one of them longer than a piece."""
    texts = ["".join(NASTY) * 200, "[{" * 3_000_000]
    dumps = [json.dumps({"Nombre": t}, ensure_ascii=False) for t in texts]
    path = write(tmp_path / "r.json", "[" + ",\n".join(dumps[:1] * 4000 + dumps[1:] + dumps[:1] * 4000) + ",null]")
    found, peak = most_memory(lambda: [hash(x) for x in fl.objects_of(path, 0, None, False, 0)])
    assert found == [hash(x) for x in dumps[:1] * 4000 + dumps[1:] + dumps[:1] * 4000]
    assert peak < 48 << 20


def test_no_file_no_rows(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert fl.read_json_objects(spark, str(tmp_path / "none"), "id int").collect() == []
    assert fl.read_named_csv(spark, str(tmp_path / "none"), ["a"]).select(F.count("*")).first()[0] == 0
