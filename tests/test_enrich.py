import pytest
from pyspark.sql import functions as F

from jobmeld.operators import enrich


def run(spark, values, fn):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    got = {r["i"]: r["o"] for r in df.select("i", fn(F.col("t")).alias("o")).collect()}
    return [got[i] for i in range(len(values))]


EDU = [
    ("Tốt nghiệp THPT", "THPT"),
    ("THCS hoặc THPT", "THCS"),
    ("outcome driven", "Trung cấp"),
    ("Cao đẳng", "Cao đẳng"),
    ("CAO ĐẲNG", "Đại học"),
    ("University", "Đại học"),
    (None, "Đại học"),
]


def test_education(spark):
    assert run(spark, [t for t, _ in EDU], enrich.education) == [w for _, w in EDU]
    assert run(spark, ["CAO ĐẲNG"], lambda c: enrich.education(c, flags="(?iu)")) == ["Cao đẳng"]


RULES = {"A": ["sql", "bán hàng"], "B": ["sql server", "it"], "C": ["tư vấn bán hàng", "tư vấn"]}


def test_keywords_count_as_whole_words_and_may_overlap(spark):
    texts = ["SQL", "with", "SQL-Server", "Tư vấn bán hàng", "it sql", "sql sql sql server", "", None, "sqlserver"]
    # one keyword each for A and B in "sql server"; the first label wins a tie
    assert run(spark, texts, lambda c: enrich.classify_single(c, RULES)) == ["A", None, "A", "C", "A", "A", None, None, None]
    assert run(spark, texts, lambda c: enrich.classify_multi(c, RULES)) == ["A", None, "A, B", "A, C", "A, B", "A, B", None, None, None]


@pytest.mark.parametrize("rules", [enrich.CATEGORY_RULES, enrich.INDUSTRY_RULES, enrich.SKILL_RULES])
def test_found_keywords_agree_with_plain_search(spark, rules):
    keywords = sorted({k for ks in rules.values() for k in ks})
    texts = [" ".join(keywords[i::7]) for i in range(7)] + [f"xx {k}, y" for k in keywords]
    want = []
    for t in texts:
        padded = " " + " ".join(t.replace(",", " ").split()) + " "
        hits = [label for label, ks in rules.items() if any(f" {k} " in padded for k in ks)]
        want.append(", ".join(hits) or None)
    assert run(spark, texts, lambda c: enrich.classify_multi(c, rules)) == want


def test_rules_cover_the_label_lists():
    assert list(enrich.CATEGORY_RULES) == enrich.JOB_CATEGORIES
    assert list(enrich.INDUSTRY_RULES) == enrich.COMPANY_INDUSTRIES
    assert list(enrich.SKILL_RULES) == enrich.SKILLS


def test_snap(spark):
    labels = enrich.JOB_CATEGORIES
    assert run(spark, ["sales", " Helthcare", "zzzz", None], lambda c: enrich.snap(c, labels, 3)) == ["Sales", "Healthcare", None, None]
    assert run(spark, ["Medi"], lambda c: enrich.snap(c, labels)) == ["Media"]


def test_prompt_holds_labels_and_text(spark):
    got = run(spark, ["Kế toán", None], lambda c: enrich.prompt(c, ["L1", "L2"], many=True))
    assert "- L1\n- L2\n" in got[0] and got[0].endswith("Kế toán") and got[1].endswith("Text:\n")


def test_scorer_runs_once_per_text_and_keeps_what_is_there(spark, tmp_path):
    log = str(tmp_path / "calls")

    def score(text, path):
        with open(path, "a") as f:
            f.write(text + "\n")
        if text == "bad":
            raise ValueError("no")
        return text.upper()

    data = [(i, t, o) for i, (t, o) in enumerate([("a", None)] * 50 + [("bad", None), ("c", "kept"), (None, None)])]
    df = spark.createDataFrame(data, "i int, t string, label string")
    got = {r["i"]: (r["label"], r["label_error"]) for r in enrich.score_texts(df, "t", score, "label", path=log).collect()}
    assert got[0] == got[49] == ("A", None)
    assert got[50] == (None, "ValueError: no") and got[51] == ("kept", None) and got[52] == (None, None)
    assert sorted(open(log).read().split()) == ["a", "bad"]


def test_idle_rows_do_not_share_one_join_key(spark):
    df = spark.range(2000).select("id", F.lit("t").alias("t"), F.lit("kept").alias("label"))
    plan = enrich.score_texts(df, "t", str.upper, "label")
    assert plan.filter("label = 'kept'").count() == 2000
