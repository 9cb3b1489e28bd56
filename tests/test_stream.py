import os
import random

from pyspark.sql import functions as F, types as T

from jobmeld.sources.store import SnapshotStore
from jobmeld.streaming import jobs as st

JOB = T.StructType([T.StructField(n, T.StringType()) for n in ("media_internal_id", "media_code", "title", "at")])


def put(path, name, *lines):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def line(i, title, at="2024-01-01T00:00:00"):
    t = "null" if title is None else f'"{title}"'
    return f'{{"media_internal_id":"{i}","media_code":"topcv","title":{t},"at":"{at}"}}'


def test_upsert_stream_continues_and_repeats_safely(spark, tmp_path, rows):
    src = tmp_path / "in"
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    put(src, "1.json", line(1, "a"), line(1, "a"), line(2, "b"))

    def run(checkpoint="cp"):
        items = st.read_stream(spark, str(src), JOB).drop("at")
        return rows(st.upsert_stream(items, store, "jobs", str(tmp_path / checkpoint)))

    assert run() == [("1", "topcv", "a"), ("2", "topcv", "b")]
    put(src, "2.json", line(2, None), line(3, "c"))
    want = [("1", "topcv", "a"), ("2", "topcv", "b"), ("3", "topcv", "c")]
    assert run() == want
    assert run() == want
    # the same input from the start again, as after a lost checkpoint
    assert run("cp2") == want
    assert len(store._complete("jobs")) <= 3


ORDERED = T.StructType([*JOB.fields[:3], T.StructField("created_at", T.StringType()), T.StructField("nth", T.LongType())])


def test_order_counts_across_runs(spark, tmp_path, rows):
    """Any division into runs, in any order of these, gives the table of one run."""
    rnd = random.Random(5)
    records = [(str(rnd.randrange(6)), "topcv", rnd.choice([None, "a", "b", "c"]), rnd.choice([None, f"c{n}"]), rnd.choice([n // 2, None])) for n in range(40)]
    tables = []
    for case, parts in enumerate([[records], [records[::2], records[1::2]], [records[25:], records[:12], records[12:25]]]):
        store, src = SnapshotStore(spark, str(tmp_path / f"tables{case}"), buckets=2), str(tmp_path / f"in{case}")
        for part in parts:
            spark.createDataFrame(part, ORDERED).coalesce(1).write.mode("append").parquet(src)
            items = st.read_stream(spark, src, ORDERED, "parquet")
            got = st.upsert_stream(items, store, "jobs", str(tmp_path / f"cp{case}"), order="nth")
        tables.append(rows(got.drop("_versions")))
    assert tables[0] == tables[1] == tables[2]
    last = {}
    for i, _, title, _, nth in sorted(records, key=lambda r: (-1 if r[4] is None else r[4], r[2] or "")):
        if title is not None:
            last[i] = title
    assert {r[0]: r[2] for r in tables[0] if r[2]} == last


def test_a_table_without_versions_gives_way(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    store.write(spark.createDataFrame([("1", "topcv", "old", "c0", None)], ORDERED), "jobs")
    for title, nth in (("new", 5), ("late", 3), (None, 9)):
        spark.createDataFrame([("1", "topcv", title, "c1", nth)], ORDERED).write.parquet(str(tmp_path / "changes" / "_batch=0"))
        got = st.merge_pending(store, "jobs", str(tmp_path / "changes"), order="nth")
    assert rows(got.select("title", "created_at", "nth")) == [("new", "c0", 9)]


def test_many_batches_are_merged_in_one_rewrite(spark, tmp_path, rows):
    src = tmp_path / "in"
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    for n in range(4):
        put(src, f"{n}.json", line(1, f"v{n}"), line(10 + n, None))
        os.utime(src / f"{n}.json", (1000 + n, 1000 + n))
    items = st.read_stream(spark, str(src), JOB, per_batch=1).drop("at")
    got = rows(st.upsert_stream(items, store, "jobs", str(tmp_path / "cp")))
    assert got == [("1", "topcv", "v3")] + [(str(10 + n), "topcv", None) for n in range(4)]
    assert store._complete("jobs") == [1]


def test_a_merge_that_stopped_half_way_is_made_up_for(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "tables"))
    pending = str(tmp_path / "changes")
    for n, title in enumerate(["a", None]):
        batch = spark.createDataFrame([("1", "topcv", title)], "media_internal_id string, media_code string, title string")
        batch.write.parquet(f"{pending}/_batch={n}")
    # a batch folder whose write did not finish
    batch.write.parquet(f"{pending}/_batch=2")
    os.remove(f"{pending}/_batch=2/_SUCCESS")
    assert rows(st.merge_pending(store, "jobs", pending)) == [("1", "topcv", "a")]
    assert rows(st.merge_pending(store, "jobs", pending)) == [("1", "topcv", "a")]


def test_first_seen_drops_late_repeats(spark, tmp_path, rows):
    src = tmp_path / "in"
    put(src, "1.json", line(1, "a"), line(2, "b"))

    def run():
        items = st.read_stream(spark, str(src), JOB).withColumn("at", F.col("at").cast("timestamp_ntz"))
        (
            st.first_seen(items, ["media_internal_id"], "at", "10 days")
            .select("media_internal_id")
            .writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "cp"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
            .awaitTermination()
        )
        return rows(spark.read.parquet(str(tmp_path / "out")))

    assert run() == [("1",), ("2",)]
    put(src, "2.json", line(1, "again"), line(3, "c"))
    assert run() == [("1",), ("2",), ("3",)]


def test_land_appends_each_item_once(spark, tmp_path):
    src = tmp_path / "in"
    put(src, "1.json", line(1, "a"))

    def run():
        items = st.read_stream(spark, str(src), JOB)
        st.land(items, str(tmp_path / "raw"), str(tmp_path / "cp"), "feed", F.col("at").cast("timestamp")).awaitTermination()
        return spark.read.json(str(tmp_path / "raw")).count()

    assert run() == 1
    put(src, "2.json", line(2, "b", "2024-02-01T00:00:00"))
    assert run() == 2
    assert run() == 2
