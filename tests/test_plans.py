"""What the plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from jobmeld.functions import address
from jobmeld.operators import dedupe, extract, identity, lookup, matching, survivorship
from jobmeld.queries.lookalikes import claims, held

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture
def sides(spark, tmp_path):
    """Raw and master tables on disk, wider than any matcher needs."""
    n = 1000
    key = F.col("id").cast("string")
    raw = spark.range(n).select(
        key.alias("company_id"), key.alias("company_only_name"), key.alias("company_domain"), key.alias("street"), key.alias("ward"),
        key.alias("province"), F.repeat(key, 50).alias("company_description"),
    )
    master = raw.selectExpr(
        "company_id AS corporate_number", "company_only_name AS standard_name", "company_domain AS domain", "street", "ward", "province",
        "company_description AS description",
    )
    raw.write.parquet(str(tmp_path / "raw"))
    master.write.parquet(str(tmp_path / "master"))
    return spark.read.parquet(str(tmp_path / "raw")), spark.read.parquet(str(tmp_path / "master"))


def test_all_matchers_share_one_scan_per_side_and_one_shuffle(sides):
    df = matching.candidates(*sides)
    text = plan(df)
    assert exchanges(df) == 1 and "Join" not in text
    assert text.count("FileScan") == 2 and "description" not in text


def test_one_matcher_reads_its_key_columns_only(sides):
    text = plan(matching.candidates(*sides, [matching.BY_NAME["domain"]]))
    assert re.findall(r"ReadSchema: (\S+)", text) == ["struct<company_id:string,company_domain:string>", "struct<corporate_number:string,domain:string>"]


def test_merge_is_two_shuffles_and_no_join(spark):
    df = identity.merge(held(spark, SF), claims(spark, SF))
    text = plan(df)
    assert exchanges(df) == 2 and "Join" not in text and text.count("FileScan") == 2


def test_dedupe_combines_before_the_shuffle(sides):
    text = plan(dedupe.keep_first(sides[0], ["company_id"]))
    assert text.count("partial_min") == 1 and "Window" not in text


def test_survive_joins_once(sides, spark):
    cols = [("street", "street"), ("ward", "ward"), ("province", "province")]
    src = survivorship.scored(sides[1], cols, 30000, F.lit("t1"))
    df = survivorship.survive(src, src.withColumnRenamed("x", "y"))
    assert plan(df).count("Join") == 1


def test_filter_on_the_key_reaches_the_scan(sides):
    text = plan(matching.candidate_counts(*sides, [("street", "street")]).filter("company_id = '7'"))
    assert "PushedFilters" in text and "EqualTo(company_id,7)" in text


@pytest.fixture
def hot_settings(spark):
    """Limits low enough that a test's hot key counts as one, and no broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n=60_000):
    """Rows of which a third share one key."""
    i = F.col("id")
    return spark.range(0, n, 1, 8).select(
        i, F.when(i % 3 == 0, F.lit("0")).otherwise((i % 5000).cast("string")).alias("k"), F.sha2(i.cast("string"), 512).alias("pad")
    )


def final_plan(df):
    df.collect()
    return plan(df)


def test_a_hot_company_is_split_in_the_job_lookup(spark, hot_settings):
    k = F.col("id").cast("string")
    master = spark.range(5000).select(k.alias("corporate_number"), k.alias("company_name"), k.alias("province"), k.alias("topcv_company_id"))
    known = lookup.company_lookup(master, "topcv_company_id")
    jobs = lookup.attach_company(hot_rows(spark), known, "k")
    assert "skew=true" in final_plan(jobs) and jobs.count() == 60_000


def test_a_hot_key_is_split_when_candidates_are_counted(spark, hot_settings):
    master = spark.range(5000).select(F.col("id").cast("string").alias("c"), F.col("id").cast("string").alias("m"))
    raw = hot_rows(spark).withColumn("rid", F.col("pad"))
    counted = matching.candidate_counts(raw, master, [("k", "m")], "rid", "c")
    assert "skew=true" in final_plan(counted) and counted.count() == 60_000


def test_hot_keys_are_split_against_known_ids(spark, hot_settings):
    known = hot_rows(spark).filter("id % 2 = 0").select("k")
    left = dedupe.unseen(hot_rows(spark), known, "k")
    assert "skew=true" in final_plan(left)


def test_a_hot_link_is_split_when_context_is_carried(spark, hot_settings):
    pages = hot_rows(spark).select(
        F.col("id").alias("page_id"), F.concat(F.lit("https://x.vn/"), "id").alias("url"),
        F.concat(F.lit('<a href="/'), "k", F.lit('">'), "pad").alias("html"),
    )
    out = extract.with_parent_context(pages, F.col("html"))
    assert "skew=true" in final_plan(out) and out.count() == 60_000


def test_job_upsert_reduces_and_joins_on_one_shuffle(spark, tmp_path):
    from jobmeld.operators import upsert

    cols = ["media_internal_id", "media_code", "title"]
    rows_ = spark.range(100).select(F.col("id").cast("string").alias(cols[0]), F.lit("topcv").alias(cols[1]), F.lit("t").alias(cols[2]))
    rows_.write.parquet(str(tmp_path / "t"))
    dest = spark.read.parquet(str(tmp_path / "t"))
    src = upsert.tag_source(dest.drop("media_code"), "topcv")
    assert exchanges(upsert.upsert(dest, src.select(*cols), ["media_internal_id"])) == 2


def test_an_address_takes_one_exchange_of_the_wide_side(spark, hot_settings, tmp_path):
    wide = spark.range(1000).select(
        F.concat(F.lit("no "), F.col("id").cast("string"), F.lit(", Ba Đình, Hà Nội")).alias("address"), F.repeat(F.lit("x"), 50).alias("description")
    )
    wide.write.parquet(str(tmp_path / "wide"))
    units = spark.createDataFrame(
        [("province", "Hà Nội", None, None), ("district", "Ba Đình", None, "Hà Nội")], "level string, name string, district string, province string"
    )
    df = address.split_address(spark.read.parquet(str(tmp_path / "wide")), "address", units)
    text = plan(df)
    assert text.count("SortMergeJoin") == 1
    # the side with the description: below the join, one exchange; the others are of units
    wide_side = [part for part in text.split("Exchange ")[1:] if "description" in part.split("\n")[0] + part.split("\n")[1]]
    assert len(wide_side) == 1
    assert {tuple(r.addr)[1:] for r in df.collect()} == {(None, "Ba Đình", "Hà Nội")}
