"""Tables in buckets: a merge reads and writes what its batch touches, with the result of a whole merge."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from jobmeld.operators import survivorship, upsert
from jobmeld.sources.store import SnapshotStore

KEYS = ["media_internal_id", "media_code"]
JOB = "media_internal_id string, media_code string, title string, benefits string, created_at string"


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "tables"), buckets=8)


def jobs(spark, rows):
    return spark.createDataFrame(rows, JOB)


def patches(store, name):
    return sorted(glob.glob(f"{store.root}/{name}/patch=*"))


def bucket_dirs(folder):
    return [d for d in os.listdir(folder) if d.startswith("_bucket=")]


def table_of(spark, n):
    return jobs(spark, [(f"j{i}", "topcv", f"t{i}", None, "t0") for i in range(n)])


def test_a_batch_of_one_key_writes_one_bucket(spark, store, rows):
    store.write_buckets(table_of(spark, 200), "jobs", KEYS)
    batch = jobs(spark, [("j7", "topcv", None, "new", "t1")])
    got = store.merge("jobs", batch, KEYS, upsert.upsert)
    (patch,) = patches(store, "jobs")
    assert len(bucket_dirs(patch)) == 1
    assert rows(got) == rows(upsert.upsert(table_of(spark, 200), batch))
    held = spark.read.parquet(patch).count()
    assert held < 200 / 8 * 2


def test_only_touched_buckets_are_read(spark, store):
    store.write_buckets(table_of(spark, 400), "jobs", KEYS)
    seen = []

    def how(dest, src):
        seen.append(sorted(r.media_internal_id for r in dest.collect()))
        return upsert.upsert(dest, src)

    store.merge("jobs", jobs(spark, [("j1", "topcv", "x", None, "t1"), ("j1", "topcv", None, "y", "t1")]), KEYS, how)
    assert "j1" in seen[0] and len(seen[0]) < 400 / 8 * 2


@pytest.mark.parametrize("seed", range(3))
def test_merges_in_buckets_equal_whole_ones(spark, store, rows, seed):
    rnd = random.Random(seed)
    whole = None
    for step in range(5):
        batch = jobs(
            spark,
            [
                (f"j{rnd.randrange(40)}", rnd.choice(["a", "b"]), rnd.choice([None, f"t{step}"]), rnd.choice([None, "x", "y"]), f"c{step}")
                for _ in range(rnd.choice([1, 3, 60]))
            ],
        )
        if step == 3:
            batch = batch.withColumn("skills", F.lit("s"))  # a column that earlier files lack
        got = store.merge("jobs", batch, KEYS, upsert.upsert)
        whole = upsert.upsert(whole if whole is not None else jobs(spark, []), batch).checkpoint()
        assert got.columns == whole.columns and rows(got) == rows(whole)
    assert patches(store, "jobs")


def test_a_patch_without_its_marker_does_not_count_and_a_rerun_heals_it(spark, store, rows):
    store.write_buckets(table_of(spark, 50), "jobs", KEYS)
    batch = jobs(spark, [("j7", "topcv", "late", None, "t1")])
    before = rows(store.read("jobs"))
    store.merge("jobs", batch, KEYS, upsert.upsert)
    os.remove(patches(store, "jobs")[0] + "/_SUCCESS")
    assert rows(store.read("jobs")) == before
    assert rows(store.merge("jobs", batch, KEYS, upsert.upsert)) == rows(upsert.upsert(table_of(spark, 50), batch))


def test_a_plain_table_is_put_in_buckets_once(spark, store, rows):
    store.write(table_of(spark, 20), "jobs")
    assert store.bucket_folders("jobs") == {}
    got = store.merge("jobs", jobs(spark, [("j3", "topcv", "x", None, "t1")]), KEYS, upsert.upsert)
    assert got.count() == 20 and store.bucket_folders("jobs") and not patches(store, "jobs")
    store.buckets = 99  # a table keeps its number
    store.merge("jobs", jobs(spark, [("j4", "topcv", "x", None, "t1")]), KEYS, upsert.upsert)
    assert {b.partition("of")[2] for b in store.bucket_folders("jobs")} == {"8"}


def test_empty_batches_and_null_keys(spark, store, rows):
    none = jobs(spark, [])
    assert store.merge("jobs", none, KEYS, upsert.upsert).count() == 0 and store.exists("jobs")
    store.merge("jobs", jobs(spark, [(None, None, "x", None, "t0"), ("j", None, "y", None, "t0")]), KEYS, upsert.upsert)
    before = os.listdir(f"{store.root}/jobs")
    assert store.merge("jobs", none, KEYS, upsert.upsert).count() == 2
    assert os.listdir(f"{store.root}/jobs") == before


def test_a_later_whole_write_ends_earlier_patches(spark, store, rows):
    store.write_buckets(table_of(spark, 30), "jobs", KEYS)
    store.merge("jobs", jobs(spark, [("j7", "topcv", "late", None, "t1")]), KEYS, upsert.upsert)
    few = table_of(spark, 3)
    store.write_buckets(few, "jobs", KEYS)
    assert rows(store.read("jobs")) == rows(few)
    assert store.expire("jobs", 0) == 1 and not patches(store, "jobs")
    assert rows(store.read("jobs")) == rows(few)


def test_golden_record_in_buckets(spark, store, rows):
    src = spark.range(100).select(F.col("id").cast("string").alias("corporate_number"), F.concat(F.lit("n"), "id").alias("name"))
    first = survivorship.scored(src, [("name", "company_name")], 20000, F.lit("t0"))
    better = survivorship.scored(src.filter("id < 2").withColumn("name", F.lit("better")), [("name", "company_name")], 30000, F.lit("t1"))
    store.write_buckets(first, "master/company", ["corporate_number"])
    got = store.merge("master/company", better, ["corporate_number"], survivorship.survive)
    assert rows(got) == rows(survivorship.survive(first, better))
    assert len(bucket_dirs(patches(store, "master/company")[0])) <= 2
