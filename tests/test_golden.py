import random

import pytest
from pyspark.sql import functions as F

from jobmeld.operators import survivorship, upsert
from jobmeld.sources import schema


def table(spark, data, at="t0"):
    rows = [(k, v, q, at if q is not None else None, at, at) for k, v, q in data]
    return spark.createDataFrame(
        rows, "corporate_number string, domain string, domain_quality int, domain_updated_at string, updated_at string, created_at string"
    )


CASES = [
    (("x", 24000), ("y", 30000), ("y", 30000, "t1")),
    (("x", 30000), ("y", 24000), ("x", 30000, "t0")),
    (("x", 30000), ("y", 30000), ("y", 30000, "t1")),
    (("x", 24000), ("", 0), ("x", 24000, "t0")),
    ((None, None), ("y", 20000), ("y", 20000, "t1")),
    ((None, None), (None, 0), (None, None, "t0")),
]


@pytest.mark.parametrize("dest,src,want", CASES)
def test_survive(spark, dest, src, want):
    out = survivorship.survive(table(spark, [("C", *dest)]), table(spark, [("C", *src)], "t1")).first()
    assert (out["domain"], out["domain_quality"], out["updated_at"]) == want
    assert out["created_at"] == "t0"


def test_new_key_comes_in_whole(spark):
    out = survivorship.survive(table(spark, []), table(spark, [("C", "", 0)], "t1")).first()
    assert (out["domain"], out["domain_quality"], out["updated_at"], out["created_at"]) == ("", 0, "t1", "t1")


def test_columns_of_one_side_only(spark):
    dest = table(spark, [("C", "x", 24000)]).withColumn("email", F.lit("e")).withColumn("email_quality", F.lit(20000)).withColumn(
        "email_updated_at", F.lit("t0")
    )
    src = survivorship.scored(
        spark.createDataFrame([("C", ["a"]), ("D", [])], "corporate_number string, industry array<string>"),
        [("industry", "industry")], 28000, F.lit("t1"),
    )
    got = {r["corporate_number"]: r for r in survivorship.survive(dest, src).collect()}
    assert got["C"]["email"] == "e" and got["C"]["industry"] == ["a"] and got["C"]["industry_quality"] == 28000
    assert got["D"]["email"] is None and got["D"]["industry"] == [] and got["D"]["industry_quality"] == 0


@pytest.mark.parametrize("seed", range(3))
def test_survive_twice_is_once_and_never_lowers_quality(spark, seed):
    rnd = random.Random(seed)

    def rows_():
        return [
            (f"C{i}", rnd.choice(["", None, "a", "b"]), 0) for i in rnd.sample(range(30), 20)
        ]

    dest = table(spark, [(k, v, 24000 if v else 0) for k, v, _ in rows_()])
    src = table(spark, [(k, v, rnd.choice([20000, 30000]) if v else 0) for k, v, _ in rows_()], "t1")
    once = survivorship.survive(dest, src)
    twice = survivorship.survive(once, src)
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)
    before = {r["corporate_number"]: r["domain_quality"] for r in dest.collect()}
    after = {r["corporate_number"]: r["domain_quality"] for r in once.collect()}
    assert all(after[k] >= q for k, q in before.items())


JOB = "media_internal_id string, media_code string, title string, benefits string, created_at string, updated_at string"


def test_upsert(spark, rows):
    dest = spark.createDataFrame([("1", "a", "a", "b", "t0", "t0"), ("2", "a", "k", None, "t0", "t0")], JOB)
    src = spark.createDataFrame([("1", "a", None, "c", "t1", "t1"), ("1", "b", "n", None, "t1", "t1")], JOB)
    out = upsert.upsert(dest, src)
    assert rows(out) == [
        ("1", "a", "a", "c", "t0", "t1"),
        ("1", "b", "n", None, "t1", "t1"),
        ("2", "a", "k", None, "t0", "t0"),
    ]
    assert rows(upsert.upsert(out, src)) == rows(out)


def test_upsert_takes_a_key_that_the_batch_repeats_once(spark):
    dest = schema.empty_like(spark, spark.createDataFrame([], JOB).schema)
    src = spark.createDataFrame([("1", "a", t, None, "t1", "t1") for t in "zyx"], JOB)
    assert [r["title"] for r in upsert.upsert(dest, src).collect()] == ["z"]


def test_a_null_in_a_repeated_key_erases_nothing(spark, rows):
    dest = spark.createDataFrame([("1", "a", "old", None, "t0", "t0")], JOB)
    src = spark.createDataFrame([("1", "a", None, "b", "t1", "t1"), ("1", "a", "new", None, "t1", "t1")], JOB)
    assert rows(upsert.upsert(dest, src)) == [("1", "a", "new", "b", "t0", "t1")]


@pytest.mark.parametrize("seed", range(4))
def test_any_division_into_batches_gives_the_same_table(spark, tmp_path, rows, seed):
    from jobmeld.sources.store import SnapshotStore
    from jobmeld.streaming import jobs as st

    rnd = random.Random(seed)
    data = [(str(rnd.randrange(5)), "m", rnd.choice([None, "a", "b"]), rnd.choice([None, "c", "d"]), rnd.randrange(9)) for _ in range(30)]
    ddl = "media_internal_id string, media_code string, a string, b string, at int"
    got = []
    for parts in (1, 4):
        shuffled = rnd.sample(data, len(data))
        for n in range(parts):
            spark.createDataFrame(shuffled[n::parts], ddl).write.parquet(str(tmp_path / f"p{parts}" / f"_batch={n}"))
        store = SnapshotStore(spark, str(tmp_path / f"t{parts}"))
        got.append(rows(st.merge_pending(store, "jobs", str(tmp_path / f"p{parts}"), order="at")))
    assert got[0] == got[1]
    for key, _, a, b, _ in got[0]:
        for i, value in ((2, a), (3, b)):
            known = [(r[4], r[i]) for r in data if r[0] == key and r[i] is not None]
            assert value == (max(known)[1] if known else None)


def test_first_ingest_id_wins(spark):
    dest = spark.createDataFrame([("1", "a", "i0")], "media_internal_id string, media_code string, _ingest_id string")
    src = spark.createDataFrame([("1", "a", "i1"), ("2", "a", "i1")], "media_internal_id string, media_code string, _ingest_id string")
    assert sorted(r["_ingest_id"] for r in upsert.upsert(dest, src).collect()) == ["i0", "i1"]


def test_type_conflict_is_refused(spark):
    with pytest.raises(schema.SchemaConflict):
        schema.evolve(spark.createDataFrame([], "a string"), spark.createDataFrame([], "a int"))


def test_conform_unifies_the_shapes_of_a_column(spark):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("kind", T.ArrayType(T.StringType())), T.StructField("n", T.DecimalType(18, 2)), T.StructField("s", T.StringType())])
    a = schema.conform(spark.createDataFrame([("FULL", "12", ["x", "y"]), (None, "oops", None)], "kind string, n string, s array<string>"), want)
    assert a.schema == want
    got = [tuple(r) for r in a.collect()]
    assert got[0][0] == ["FULL"] and float(got[0][1]) == 12 and got[0][2] == "x, y"
    assert got[1] == (None, None, None)


@pytest.mark.parametrize("seed", range(3))
def test_folding_feeds_equals_merging_them_in_turn(spark, rows, seed):
    rnd = random.Random(seed)

    def feed(quality, cols):
        data = [(f"C{k}", *[rnd.choice(["", None, f"{c}{quality}"]) for c in cols]) for k in rnd.sample(range(20), 12)]
        df = spark.createDataFrame(data, "corporate_number string, " + ", ".join(f"{c} string" for c in cols))
        return survivorship.scored(df, [(c, c) for c in cols], quality, F.lit("t1"))

    feeds = [feed(30000, ["a", "b"]), feed(24000, ["a", "c"]), feed(30000, ["b", "c", "a"]), feed(28000, ["c"])]
    base = survivorship.scored(
        spark.createDataFrame([(f"C{k}", rnd.choice(["", "old"]), None) for k in range(10)], "corporate_number string, a string, b string"),
        [("a", "a"), ("b", "b")], 28000, F.lit("t0"),
    )
    turn = base
    for f in feeds:
        turn = survivorship.survive(turn, f)
    once = survivorship.survive(base, survivorship.fold(feeds)).select(*turn.columns)
    assert rows(once) == rows(turn)


@pytest.mark.parametrize("seed", range(3))
def test_folding_batches_equals_upserting_them_in_turn(spark, rows, seed):
    rnd = random.Random(seed)
    ddl = "media_internal_id string, media_code string, a string, _ingest_id string, created_at string"

    def batch(n):
        return spark.createDataFrame(
            [(str(rnd.randrange(6)), "m", rnd.choice([None, f"a{n}", f"b{n}"]), rnd.choice([None, f"i{n}"]), f"t{n}") for _ in range(8)], ddl
        )

    batches = [batch(n) for n in range(4)]
    turn = schema.empty_like(spark, batches[0].schema)
    for b in batches:
        turn = upsert.upsert(turn, b)
    changes = schema.consolidate([b.withColumn("_batch", F.lit(n)) for n, b in enumerate(batches)])
    assert rows(upsert.fold(changes, "_batch").select(*turn.columns)) == rows(turn)


@pytest.mark.parametrize("repeats", [0, 1, 9])
def test_upsert_of_a_stored_batch_equals_upsert(spark, tmp_path, rows, repeats):
    ddl = "media_internal_id string, media_code string, title string, benefits string, _ingest_id string, created_at string"
    dest = spark.createDataFrame([(f"j{i}", "m", f"t{i}", None, f"i{i}", "t0") for i in range(20)], ddl)
    batch = [(f"j{i}", "m", None if i % 2 else f"n{i}", "x", f"k{i}", "t1") for i in range(10, 30)] + [(None, "m", "no key", None, None, "t1")]
    batch += [(f"j{10 + k % 3}", "m", rnd_title, "y", f"z{k}", "t2") for k, rnd_title in enumerate(["b", None, "a"] * 3)][:repeats]
    spark.createDataFrame(batch, ddl).withColumn("skills", F.lit("s")).write.parquet(str(tmp_path / "batch"))
    src = spark.read.parquet(str(tmp_path / "batch"))
    got = upsert.upsert_stored(dest, src)
    assert got.columns == upsert.upsert(dest, src).columns and rows(got) == rows(upsert.upsert(dest, src))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("SortAggregate" in plan) == (repeats > 0)
