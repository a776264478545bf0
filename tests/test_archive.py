"""The archive of captures: any order, landed again, late, corrected; buckets, compaction and broken runs."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from nightshare.plans import archive as ar
from nightshare.streaming import archive as store
from nightshare.streaming import ingest as st

SCHEMA = "id int, name string, price double, captured date"


def frame(spark, rows):
    return spark.createDataFrame([(i, n, p, dt.date(2025, 1, 1) + dt.timedelta(d)) for i, n, p, d in rows], SCHEMA)


def plain(rows):
    """Archive and log of a set of captures; of rows of one key and day the largest counts."""
    by, order = {}, lambda r: tuple((x is not None, x or 0) for x in r)
    for i, n, p, d in rows:
        old = by.setdefault(i, {}).get(d)
        by[i][d] = (n, p) if old is None else max(old, (n, p), key=order)
    day = lambda d: dt.date(2025, 1, 1) + dt.timedelta(d)
    archive = {(i, *days[max(days)], day(min(days)), day(max(days)), len(days)) for i, days in by.items()}
    log = set()
    for i, days in by.items():
        turn = sorted(days)
        for a, b in zip(turn, turn[1:]):
            if days[a][0] != days[b][0]:
                log.add((i, day(b), "name", days[a][0], days[b][0]))
    return archive, log


def held(spark, root):
    archive = {(r.id, r.name, r.price, r.first_seen, r.last_seen, r.captures) for r in store.read_archive(spark, root).collect()}
    return archive, {tuple(r) for r in store.read_changes(spark, root).select("id", "captured", "field", "before", "after").collect()}


@pytest.mark.parametrize("seed", range(3))
def test_any_order_of_landing_gives_the_same(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([1.0, 2.0, None]), d) for i in range(12) for d in rng.sample(range(-70, 200), 7)]
    rows += [(i, "c", 9.0, d) for i, _, _, d in rng.sample(rows, 10)]  # corrected: another row of a day
    batches = [[] for _ in range(5)]
    for r in rows:
        for n in rng.sample(range(5), rng.choice([1, 1, 2])):  # some land twice
            batches[n].append(r)
    root = str(tmp_path / "r")
    for n, batch in enumerate(batches):
        store.apply_batch(frame(spark, batch), root, "run", n, "id", ["name"], "captured", buckets=3, most_deltas=2)
    assert held(spark, root) == plain(rows)


def test_several_watched_fields_and_no_other_field(spark, tmp_path):
    root = str(tmp_path / "r")
    for n, rows in enumerate([[(1, "a", 1.0, 0)], [(1, "b", 2.0, 7)], [(1, "b", 1.0, 3)]]):
        store.apply_batch(frame(spark, rows), root, "run", n, "id", ["name", "price"], "captured")
    log = sorted(tuple(str(x) for x in r) for r in store.read_changes(spark, root).collect())
    assert log == [("1", "2025-01-04", "name", "a", "b"), ("1", "2025-01-08", "price", "1.0", "2.0")]


def test_a_batch_run_again_and_rows_without_key_or_day(spark, tmp_path):
    root = str(tmp_path / "r")
    batch = frame(spark, [(1, "a", 1.0, 0), (None, "x", 1.0, 0)]).unionByName(spark.createDataFrame([(5, "y", 1.0, None)], SCHEMA))
    for _ in range(2):
        store.apply_batch(batch, root, "run", 0, "id", ["name"], "captured")
    store.apply_batch(batch.limit(0), root, "run", 1, "id", ["name"], "captured")
    assert held(spark, root) == plain([(1, "a", 1.0, 0)])
    assert len(store.commits(spark, root)) == 1
    assert store.read_archive(spark, str(tmp_path / "none")) is None


def test_only_touched_buckets_are_written_and_old_files_go(spark, tmp_path):
    root = str(tmp_path / "r")
    store.apply_batch(frame(spark, [(i, "a", 1.0, 0) for i in range(200)]), root, "run", 0, "id", ["name"], "captured", buckets=8, most_deltas=3)
    for n in range(1, 12):
        store.apply_batch(frame(spark, [(7, f"v{n}", 1.0, n)]), root, "run", n, "id", ["name"], "captured", buckets=8, most_deltas=3)
        newest = store.commits(spark, root)[-1]
        assert os.listdir(f"{root}/archive/version={n}")[0].startswith((".", "_", "bucket="))
        assert sum(x.startswith("bucket=") for x in os.listdir(f"{root}/archive/version={n}")) == 1
        assert max(map(len, newest["live"].values())) <= 3 + 1
    assert len(store.commits(spark, root)) == 2
    folders = [(v, b) for v in os.listdir(f"{root}/archive") for b in os.listdir(f"{root}/archive/{v}") if b.startswith("bucket=")]
    assert len(folders) <= 8 + 2 * 4
    archive, log = held(spark, root)
    assert len(archive) == 200 and len(log) == 11
    assert not os.listdir(f"{root}/staged")


def test_a_broken_attempt_leaves_no_trace(spark, tmp_path):
    root = str(tmp_path / "r")
    store.apply_batch(frame(spark, [(1, "a", 1.0, 0)]), root, "run", 0, "id", ["name"], "captured")
    # Data written, commit not: as if the driver had gone in between.
    frame(spark, [(2, "z", 1.0, 1)]).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{root}/archive/version=1")
    os.makedirs(f"{root}/commits/v000000001/_temporary")
    assert held(spark, root) == plain([(1, "a", 1.0, 0)])
    store.apply_batch(frame(spark, [(1, "b", 1.0, 2)]), root, "run", 1, "id", ["name"], "captured")
    assert held(spark, root) == plain([(1, "a", 1.0, 0), (1, "b", 1.0, 2)])


def test_in_order_batches_look_at_the_last_step_only(spark):
    captures = ar.keyed_captures(frame(spark, [(1, "b", 1.0, 7)]), "id", ["name"], "captured")
    state = ar.advance(None, ar.keyed_captures(frame(spark, [(1, "a", 1.0, 0), (1, "a", 1.0, 3)]), "id", ["name"], "captured"), "id", ["name"], ["name", "price"])
    row = ar.advance(state, captures, "id", ["name"], ["name", "price"]).first()
    assert [(s.day.day, s.w.name) for s in row.steps] == [(1, "a"), (8, "b")] and row.captures == 3


def test_stream_lands_again_from_a_new_checkpoint_and_late(spark, tmp_path):
    root, rows = str(tmp_path / "root"), []
    for n, (day, name) in enumerate([(0, "a"), (31, "b"), (0, "a"), (31, "b"), (14, "z")]):
        landing, batch = str(tmp_path / f"l{n}"), [(1, name, 1.0, day), (2, "same", 1.0, day)]
        frame(spark, batch).write.parquet(landing)
        rows += batch
        st.archive_changes(spark.readStream.schema(SCHEMA).parquet(landing), root, str(tmp_path / f"cp{n}"), "id", ["name"]).awaitTermination()
        assert held(spark, root) == plain(rows)


def test_keys_with_one_plain_day_are_not_walked_and_shuffled_once(spark):
    """str02_archive_stream: the state of every day at an end, between equal ones or landed again, against all days at once."""
    days = lambda *at: ar.keyed_captures(frame(spark, list(at)), "id", ["name"], "captured")
    assert days((1, "a", 1.0, 0))._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    known = [(i, n, 1.0, d) for i in range(9) for n, d in (("a", 0), ("a", 70), (None, 140))]
    fresh = [(0, "a", 2.0, -80), (1, "b", 2.0, -1), (2, "a", 2.0, 35), (3, "a", 2.0, 70), (4, None, 2.0, 141), (5, "c", 2.0, 400), (6, "c", 2.0, 36), (7, None, 0.5, 140), (10, None, 2.0, 3)]
    state = ar.advance(None, days(*known), "id", ["name"], ["name", "price"])
    after = ar.advance(state, days(*fresh), "id", ["name"], ["name", "price"])
    want = ar.advance(None, days(*known, *fresh), "id", ["name"], ["name", "price"]).where("id <> 8")
    assert sorted(map(str, after.collect())) == sorted(map(str, want.collect()))
