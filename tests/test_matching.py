import random

import pytest
from pyspark.sql import functions as F

from jobmeld.operators import dedupe, matching

RAW = "company_id string, company_only_name string, company_domain string, street string, ward string, province string"
MASTER = "corporate_number string, standard_name string, domain string, street string, ward string, province string"


def brute(pairs):
    """The one-to-one rule by its definition."""
    by_left = {}
    for l, r in pairs:
        by_left.setdefault(l, []).append(r)
    single = [(l, rs[0]) for l, rs in by_left.items() if len(rs) == 1]
    by_right = {}
    for l, r in single:
        by_right.setdefault(r, []).append(l)
    return sorted((ls[0], r) for r, ls in by_right.items() if len(ls) == 1)


def test_mutual_unique_on_pairs(spark, rows):
    pairs = [("1", "A"), ("2", "B"), ("2", "C"), ("3", "D"), ("4", "D"), ("5", "E"), ("6", "E"), ("6", "F")]
    got = rows(matching.mutual_unique(spark.createDataFrame(pairs, "l string, r string"), "l", "r"))
    assert got == [("1", "A"), ("5", "E")] == brute(pairs)


def random_tables(seed, n=60):
    rnd = random.Random(seed)

    def value(kind):
        return rnd.choice(["", None, " "] + [f"{kind}{i}" for i in range(12)])

    raw = [(str(i), *[value(k) for k in "ndswp"]) for i in range(n)]
    master = [(f"C{i}", *[value(k) for k in "ndswp"]) for i in range(n)]
    return raw, master


@pytest.mark.parametrize("seed", range(4))
def test_all_matchers_agree_with_brute_force(spark, rows, seed):
    raw, master = random_tables(seed)
    col = {"name": 1, "domain": 2, "street": 3, "ward": 4, "province": 5}
    want = []
    for m in matching.MATCHERS:
        pairs = [
            (a[0], b[0])
            for a in raw
            for b in master
            if all((a[col[k]] or "").strip() and a[col[k]] == b[col[k]] for k in m.keys)
        ]
        want += [(l, r, m.code) for l, r in brute(pairs)]
    got = matching.candidates(spark.createDataFrame(raw, RAW), spark.createDataFrame(master, MASTER))
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_ids_agree_with_brute_force(spark, rows, seed):
    rnd = random.Random(seed)
    left = [(rnd.randrange(25), rnd.choice(["", None] + list("abcdefghijklmn"))) for _ in range(40)]
    right = [(f"C{rnd.randrange(15)}", rnd.choice(["", None] + list("abcdefghijklmn"))) for _ in range(12)]
    pairs = [(l, r) for l, a in left for r, b in right if a and a == b]
    got = matching.match_repeated(
        spark.createDataFrame(left, "l int, k string"), spark.createDataFrame(right, "r string, k string"), [("k", "k")], "l", "r"
    )
    assert rows(got) == sorted(brute(pairs), key=repr)


def test_a_key_shared_by_a_third_of_both_sides_builds_no_pairs(spark):
    n = 300_000
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    blank = [F.lit("").alias(c) for c in ("company_domain", "street", "ward", "province")]
    raw = spark.range(n).select(F.col("id").cast("string").alias("company_id"), hot.alias("company_only_name"), *blank)
    blank = [F.lit("").alias(c) for c in ("domain", "street", "ward", "province")]
    master = spark.range(n).select(F.col("id").cast("string").alias("corporate_number"), hot.alias("standard_name"), *blank)
    # a pairwise join would have 10^10 pairs here
    got = matching.candidates(raw, master)
    assert got.count() == n - n // 3
    assert got.filter("company_id != corporate_number").isEmpty()


def test_match_reduces_the_raw_side_to_one_row_per_id(spark, rows):
    raw = spark.createDataFrame([("1", "a", "", "", "", ""), ("1", "a", "", "", "", "x")], RAW)
    master = spark.createDataFrame([("C", "a", "", "", "", "")], MASTER)
    got = matching.match(raw, master, "name", F.lit("2024-01-01").cast("timestamp"))
    assert [r["company_id"] for r in got.collect()] == ["1"]


def test_missing_key_columns_leave_the_matchers_that_need_them_out(spark, rows):
    raw = spark.createDataFrame([("1", "a", "s", "p")], "company_id string, company_only_name string, street string, province string")
    master = spark.createDataFrame([("C", "a", "d", "s", "w", "p")], MASTER)
    assert rows(matching.candidates(raw, master)) == [("1", "C", 35000), ("1", "C", 40000), ("1", "C", 45000)]
    with pytest.raises(ValueError):
        matching.candidates(raw.select("company_id"), master)


def test_keep_first_is_the_same_however_rows_are_laid_out(spark, rows):
    data = [(i % 7, f"v{(i * 37) % 50}", None if i % 5 else i) for i in range(300)]
    df = spark.createDataFrame(data, "k int, v string, n int")
    want = rows(dedupe.keep_first(df, ["k"]))
    assert rows(dedupe.keep_first(df.repartition(5).orderBy(F.rand(1)), ["k"])) == want
    assert len(want) == 7


def test_keep_first_with_maps_and_a_null_key(spark, rows):
    df = spark.createDataFrame([(None, {"a": "1"}), (None, {"a": "0"}), (1, {})], "k int, m map<string,string>")
    assert rows(dedupe.keep_first(df, ["k"])) == [(1, {}), (None, {"a": "0"})]


def test_keep_fullest(spark, rows):
    df = spark.createDataFrame(
        [("C", "2", "", "x"), ("C", "1", "y", "x"), ("C", "0", None, None), ("D", "9", "", "")], "c string, id string, a string, b string"
    )
    assert rows(dedupe.keep_fullest(df, "c", ["a", "b"], "id")) == [("C", "1", "y", "x"), ("D", "9", "", "")]


def test_unseen(spark, rows):
    items = spark.createDataFrame([(1,), (2,), (3,)], "job_id int")
    known = spark.createDataFrame([(2, "x"), (2, "y")], "job_id int, other string")
    assert rows(dedupe.unseen(items, known, "job_id")) == [(1,), (3,)]
