import random

import pytest

from jobmeld.operators import identity, lookup

DDL = "company_id string, corporate_number string, identify_method int, updated_at string, created_at string"


def frame(spark, triples, at):
    return spark.createDataFrame([(*t, at, at) for t in triples], DDL)


def merged(spark, held, cand, rule="parity"):
    out = identity.merge(frame(spark, held, "old"), frame(spark, cand, "new"), rule)
    return sorted(tuple(r) for r in out.collect())


def brute(held, cand, rule):
    """The merge rules, row by row."""
    cand = [s for s in cand if not any(d[1] == s[1] and s[2] <= d[2] for d in held)]
    out = []
    for d in held:
        same = next((s for s in cand if s[0] == d[0]), None)
        if same and same[2] >= d[2]:
            out.append((*same, "new", "old"))
        elif any(s[1] == d[1] and s[0] != d[0] for s in cand):
            continue
        else:
            out.append((*d, "old", "old"))
    for s in cand:
        by_id = any(d[0] == s[0] for d in held)
        by_corp = any(d[1] == s[1] for d in held)
        if not by_id and (rule == "replace" or not by_corp):
            out.append((*s, "new", "new"))
    return sorted(out)


CASES = [
    ([("1", "A", 40000)], [("1", "A", 30000)], [("1", "A", 40000, "old", "old")]),
    ([("1", "A", 40000)], [("1", "A", 45000)], [("1", "A", 45000, "new", "old")]),
    ([("1", "A", 40000)], [("1", "B", 45000)], [("1", "B", 45000, "new", "old")]),
    ([("1", "A", 40000)], [("1", "B", 30000)], [("1", "A", 40000, "old", "old")]),
    ([("1", "A", 40000)], [("2", "A", 45000)], []),
    ([("1", "A", 40000)], [("2", "B", 30000)], [("1", "A", 40000, "old", "old"), ("2", "B", 30000, "new", "new")]),
    # a row claimed by one candidate and updated by another: the update wins
    ([("1", "A", 40000)], [("1", "B", 45000), ("2", "A", 45000)], [("1", "B", 45000, "new", "old")]),
]


@pytest.mark.parametrize("held,cand,want", CASES)
def test_merge_cases(spark, held, cand, want):
    assert merged(spark, held, cand) == want == brute(held, cand, "parity")


def test_replace_inserts_the_candidate_that_took_a_number_over(spark):
    assert merged(spark, [("1", "A", 40000)], [("2", "A", 45000)], "replace") == [("2", "A", 45000, "new", "new")]


def random_map(rnd, codes):
    ids = rnd.sample(range(40), 25)
    corps = rnd.sample(range(40), 25)
    return [(str(i), f"C{c}", rnd.choice(codes)) for i, c in zip(ids, corps)]


@pytest.mark.parametrize("rule", ["parity", "replace"])
@pytest.mark.parametrize("seed", range(4))
def test_merge_agrees_with_the_rules_and_stays_one_to_one(spark, rule, seed):
    rnd = random.Random(seed)
    codes = [30000, 35000, 40000, 45000]
    held, cand = random_map(rnd, codes), random_map(rnd, codes)
    got = merged(spark, held, cand, rule)
    assert got == brute(held, cand, rule)
    assert len({r[0] for r in got}) == len(got) == len({r[1] for r in got})


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        identity.merge(frame(spark, [], "a"), frame(spark, [], "b"), "other")


def test_cascade_equals_step_by_step_merging(spark):
    rnd = random.Random(7)
    from jobmeld.operators.matching import MATCHERS

    cands = [(i, c, m.code) for m in MATCHERS for i, c, _ in random_map(rnd, [m.code])]
    want = []
    for n, m in enumerate(MATCHERS):
        step = [c for c in cands if c[2] == m.code]
        if n == 0:
            want = [(*s, "new", "new") for s in step]
            continue
        rows_ = brute([w[:3] for w in want], step, "parity")
        made = {w[0]: w[4] for w in want}
        kept = {w[:3]: w for w in want}
        want = [kept.get(r[:3], (*r[:3], "new", made.get(r[0], "new"))) if r[3] == "old" else (*r[:3], "new", "new") for r in rows_]
    got = identity.cascade(None, frame(spark, cands, "new"))
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(w[:3] for w in want)


def test_overlaps_uses_no_nested_loop(spark):
    pairs = identity.overlaps(frame(spark, [("1", "A", 1)], "x"), frame(spark, [("1", "A", 1)], "y"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert pairs.count() == 1


def test_mint(spark):
    import hashlib

    df = spark.createDataFrame(
        [("1", "a", "C1"), ("2", "a", None), ("3", "", None), ("4", None, None), ("5", " ", None)],
        "company_id string, company_only_name string, corporate_number string",
    )
    got = {r["company_id"]: r["corporate_number"] for r in identity.mint(df, "topcv").collect()}
    assert got["1"] == "C1"
    assert got["2"] == hashlib.sha256(b"a").hexdigest()
    assert len({got["3"], got["4"], got["5"]}) == 3
    shared = {r["company_id"]: r["corporate_number"] for r in identity.mint(df, "topcv", blank="shared").collect()}
    assert shared["3"] == shared["4"] == hashlib.sha256(b"").hexdigest()


def test_lookup_takes_all_values_from_one_row(spark, rows):
    master = spark.createDataFrame(
        [("C2", "x", None, "7"), ("C1", None, "HN", "7"), ("C3", "z", "HCM", None)],
        "corporate_number string, company_name string, province string, topcv_company_id string",
    )
    assert rows(lookup.company_lookup(master, "topcv_company_id")) == [("7", "C1", None, "HN")]


def test_jobs_of_unknown_companies_fall_out(spark, rows):
    known = spark.createDataFrame([("7", "C1", "n", "HN")], "company_id string, corporate_number string, master_company_name string, province string")
    jobs = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "job_id int, job_company_id bigint")
    assert rows(lookup.attach_company(jobs, known, "job_company_id").select("job_id", "province")) == [(1, "HN")]
