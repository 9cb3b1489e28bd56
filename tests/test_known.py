"""Known ids: a bitmap spares reading the ids of items that are new for sure."""

import random

import pytest
from pyspark.sql import functions as F

from jobmeld.operators import dedupe, known
from jobmeld.sources.store import SnapshotStore


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "tables"), buckets=16)


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "k long")


@pytest.mark.parametrize("places", [8, 1 << 20, 1 << 32])
def test_unseen_equals_the_anti_join(spark, store, rows, places):
    """Whatever the bitmap's size, so with next to every bit set as well."""
    rnd, ids, held = random.Random(places), known.KnownIds(store, "jobs", places), set()
    items = numbers(spark, [None, *(rnd.randint(0, 200) for _ in range(150)), 10**15])
    assert rows(ids.unseen(items, "k")) == rows(items)
    for n in (40, 3):
        batch = [rnd.randint(0, 200) for _ in range(n)]
        held |= set(batch)
        ids.add(numbers(spark, [*batch, batch[0], None]), "k")
        got = rows(ids.unseen(items, "k"))
        assert got == rows(dedupe.unseen(items, numbers(spark, held), "k"))
        assert got == sorted(((r.k,) for r in items.collect() if r.k not in held), key=repr)


def test_ids_are_read_for_survivors_only(spark, store, monkeypatch):
    ids = known.KnownIds(store, "jobs")
    ids.add(spark.range(2000).select(F.col("id").alias("k")), "k")
    maybe, new = ids.parted(spark.range(1999, 4000).select(F.col("id").alias("k")), "k")
    assert maybe.count() == 1 and new.count() == 2000
    read = []
    whole = store._load
    monkeypatch.setattr(store, "_load", lambda name, folders: read.append((name, len(folders))) or whole(name, folders))
    assert ids.unseen(spark.range(1999, 4000).select(F.col("id").alias("k")), "k").count() == 2000
    assert ("jobs/ids", 1) in read


def test_a_half_written_batch_is_made_up_for(spark, store):
    ids = known.KnownIds(store, "jobs")
    ids.add(numbers(spark, [1, 2]), "k")
    # the bitmap got the batch, the ids did not
    seen = store.merge
    store.merge = lambda name, *a: seen(name, *a) if name.endswith("bits") else None
    ids.add(numbers(spark, [3]), "k")
    store.merge = seen
    items = numbers(spark, [1, 3, 4])
    assert sorted(r.k for r in ids.unseen(items, "k").collect()) == [3, 4]
    ids.add(numbers(spark, [3]), "k")
    assert [r.k for r in ids.unseen(items, "k").collect()] == [4]


def test_columns_of_items_stay(spark, store):
    ids = known.KnownIds(store, "jobs")
    ids.add(numbers(spark, [1]), "k")
    items = spark.createDataFrame([("1", "a", 5), ("2", "b", 6)], "id string, bits string, row int")
    got = ids.unseen(items, "id")
    assert got.columns == ["id", "bits", "row"] and [tuple(r) for r in got.collect()] == [("2", "b", 6)]
