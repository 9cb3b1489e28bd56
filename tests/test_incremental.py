"""Identification batch by batch: any division gives the map of a run over all companies."""

import random

import pytest
from pyspark.sql import functions as F

from jobmeld.operators import identity, incremental, matching
from jobmeld.plans import steps
from jobmeld.sources.store import SnapshotStore

RAW = "company_id string, company_only_name string, company_domain string, street string, ward string, province string"
MASTER = "corporate_number string, standard_name string, domain string, street string, ward string, province string"
FEW = [matching.BY_NAME[n] for n in ("name", "domain", "province_street")]


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path / "tables"), buckets=2)


def company(rnd, key):
    # few values, so that keys repeat, and blanks
    return (key, *[rnd.choice(["", None, *[f"{c}{k}" for k in range(n)]]) for c, n in (("n", 9), ("d", 9), ("s", 6), ("w", 2), ("p", 2))])


def whole(spark, raw, master, conflict="parity"):
    pairs = matching.candidates(spark.createDataFrame(list(raw.values()), RAW), spark.createDataFrame(list(master.values()), MASTER), FEW)
    found = identity.cascade(None, matching.stamp(pairs, F.lit("t")), FEW, conflict)
    return {(r.company_id, r.corporate_number, r.identify_method) for r in found.collect()}


@pytest.mark.parametrize("seed,conflict", [(1, "parity"), (2, "replace")])
def test_any_division_equals_the_whole_run(spark, store, seed, conflict):
    rnd = random.Random(seed)
    raw, master = {}, {}
    for step in range(3):
        new_raw = {k: company(rnd, k) for k in rnd.sample([f"r{i}" for i in range(25)], 14)}
        new_master = {k: company(rnd, k) for k in rnd.sample([f"m{i}" for i in range(25)], 14)} if step != 1 else {}
        gone = [k for k in raw if k not in new_raw and rnd.random() < 0.3]
        raw |= new_raw
        master |= new_master
        raw = {k: v for k, v in raw.items() if k not in gone}
        got = incremental.identify_changes(
            store, "id", F.lit(f"2024-01-0{step + 1}").cast("timestamp"),
            spark.createDataFrame(list(new_raw.values()), RAW),
            spark.createDataFrame(list(new_master.values()), MASTER) if new_master else None,
            spark.createDataFrame([(k,) for k in gone], "company_id string") if gone else None,
            matchers=FEW, conflict=conflict,
        )
        assert {(r.company_id, r.corporate_number, r.identify_method) for r in got.collect()} == whole(spark, raw, master, conflict)


def test_only_what_changed_is_written_and_times_stay(spark, store):
    def one(k, name):
        return (k, name, None, None, None, None)

    day = [F.lit(f"2024-01-0{d}").cast("timestamp") for d in (1, 2, 3)]
    raw = [one(f"r{i}", f"n{i}") for i in range(30)]
    master = [one(f"m{i}", f"n{i}") for i in range(30)]
    first = incremental.identify_changes(store, "id", day[0], spark.createDataFrame(raw, RAW), spark.createDataFrame(master, MASTER), matchers=FEW)
    assert first.count() == 30
    # m3 takes the name of m4: two rows go; the rest is not written again
    got = incremental.identify_changes(store, "id", day[1], None, spark.createDataFrame([one("m3", "n4")], MASTER), matchers=FEW)
    assert {r.company_id for r in got.collect()} == {f"r{i}" for i in range(30)} - {"r3", "r4"}
    # and back: r3 is new again, r4 as well; a repeated run changes nothing
    for _ in range(2):
        got = incremental.identify_changes(store, "id", day[2], None, spark.createDataFrame([one("m3", "n3")], MASTER), matchers=FEW)
        days = {r.company_id: (r.created_at.day, r.updated_at.day) for r in got.collect()}
        assert days.pop("r3") == days.pop("r4") == (3, 3) and set(days.values()) == {(1, 1)}


def test_a_chain_of_pairs_is_followed(spark):
    pairs = spark.createDataFrame([(f"r{i + d}", f"m{i}") for i in range(12) for d in (0, 1)] + [("x", "y")], "company_id string, corporate_number string")
    start = spark.createDataFrame([("r0",)], "company_id string")
    companies, reached = incremental.connected(pairs, start, pairs.select("corporate_number").filter("false"))
    assert {r.company_id for r in companies.collect()} == {f"r{i}" for i in range(13)}
    assert reached.count() == 24


def test_nothing_given(store):
    with pytest.raises(ValueError):
        incremental.identify_changes(store, "id", F.lit("t"))


def test_step_takes_raw_rows_as_crawled(spark, store):
    raw = spark.createDataFrame([("r1", "n1", None), ("r1", "n1", "d1"), ("r2", "n2", None)], "company_id string, company_only_name string, company_domain string")
    master = spark.createDataFrame([("m1", "n1", "d1", None, None, None)], MASTER)
    got = steps.run_identify_changes(store, "topcv", F.lit("2024-01-01").cast("timestamp"), raw, master)
    assert [(r.company_id, r.corporate_number) for r in got.collect()] == [("r1", "m1")]
