import os

import pytest
from pyspark.sql import Observation, functions as F, types as T

from jobmeld import session
from jobmeld.plans import specs, steps
from jobmeld.sources import jsonl, schema
from jobmeld.sources.store import SnapshotStore, table_exists


@pytest.fixture
def store(spark, tmp_path):
    return SnapshotStore(spark, str(tmp_path))


def test_snapshots(spark, store, rows):
    assert not store.exists("a/b")
    with pytest.raises(FileNotFoundError):
        store.read("a/b")
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    store.create(df, "a/b")
    with pytest.raises(FileExistsError):
        store.create(df, "a/b")
    # replace with another schema, computed from the table itself
    store.write(store.read("a/b").select((F.col("k") + 1).alias("k"), F.lit(True).alias("w")), "a/b")
    assert rows(store.read("a/b")) == [(2, True)]
    assert store.read("a/b", ["k"]).columns == ["k"]
    assert store.register("a/b") == "a_b" and spark.sql("SELECT sum(k) AS s FROM a_b").first()["s"] == 2


def test_a_snapshot_without_its_marker_does_not_count(spark, store, rows):
    store.write(spark.range(1), "t")
    store.write(spark.range(2), "t")
    os.remove(os.path.join(store.root, "t", "snapshot=00000002", "_SUCCESS"))
    assert store.read("t").count() == 1
    assert store.write(spark.range(3), "t").count() == 3
    assert store.exists("t")


def test_a_frame_survives_later_writes(spark, store):
    first = store.write(spark.range(7), "t")
    for n in range(10):
        store.write(spark.range(n), "t")
    assert first.count() == 7 and len(store._complete("t")) == 11


def test_expire_goes_by_age_and_keeps_the_newest(spark, store):
    for n in range(1, 5):
        store.write(spark.range(n), "t")
    assert store.expire("t", 3600) == 0
    for n in (2, 3):
        os.utime(os.path.join(store.root, "t", f"snapshot={n:08d}", "_SUCCESS"), (1000, 1000))
    # snapshots 1 and 2 were replaced long ago, 3 only now
    assert store.expire("t", 3600) == 2
    assert store.read("t").count() == 4 and store._complete("t") == [3, 4]


def test_create_if_absent_partitioned(spark, store):
    df = spark.createDataFrame([(1, "topcv")], "k int, media_code string")
    assert store.create_if_absent(df, "t", ["media_code"]).count() == 0
    assert store.create_if_absent(df.withColumn("x", F.lit(1)), "t").columns == ["k", "media_code"]
    assert store.write(df, "t", ["media_code"]).filter("media_code = 'topcv'").count() == 1


def test_table_exists(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "p"))
    assert table_exists(spark, str(tmp_path / "p")) and not table_exists(spark, str(tmp_path / "q"))


def test_jsonl_keeps_lines_that_do_not_parse(spark, tmp_path, rows):
    (tmp_path / "a.jsonl").write_text('{"job_id":"1","job_title":"Kế toán"}\nbroken\n{"job_id":"2","extra":1}\n', encoding="utf-8")
    df = jsonl.read_jsonl(spark, str(tmp_path), "job_id string, job_title string")
    assert rows(df) == [("1", "Kế toán", None), ("2", None, None), (None, None, "broken")]
    assert set(jsonl.read_jsonl(spark, str(tmp_path)).columns) >= {"job_id", "job_title", "extra"}


@pytest.mark.parametrize("ddl", ["job_id string, t string", None])
def test_ingest_loses_no_line(spark, store, tmp_path, rows, ddl):
    lines = ['{"job_id":"1"}', '{"job_id":"1","t":"b"}', '{"job_id":"1","t":"a"}', "broken", '{"t":"x"}', '{"t":"x"}', '{"job_id":" "}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    df = steps.run_ingest(store, "topcv", "recruit", str(tmp_path / "in.jsonl"), ddl)
    assert rows(df.select("job_id", "t")) == [("1", "a")]
    assert rows(store.read("raw/topcv/recruit_rejected")) == [
        ("no id", '{"job_id":" "}'), ("no id", '{"t":"x"}'), ("no id", '{"t":"x"}'), ("unreadable", "broken")
    ]


def test_ingest_reads_its_input_once_and_counts(spark, store, tmp_path, monkeypatch):
    lines = ['{"job_id":"1"}', '{"job_id":"1","t":"b"}', '{"job_id":"2","t":"a"}', "broken", '{"t":"x"}', '{"job_id":" "}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(t):
        read.add(1)
        return t

    whole = steps.read_jsonl
    monkeypatch.setattr(steps, "read_jsonl", lambda *a: whole(*a).withColumn("t", seen("t")))
    df, counts = steps.ingest(store, "topcv", "recruit", str(tmp_path / "in.jsonl"), "job_id string, t string")
    assert counts == {"records": 6, "kept": 2, "no_id": 2, "unreadable": 1, "repeated": 1}
    assert df.count() == 2 and read.value == 6
    assert steps.ingest(store, "topcv", "recruit", str(tmp_path / "in.jsonl"))[1] == counts


def test_ingest_of_nothing(spark, store, tmp_path):
    (tmp_path / "in.jsonl").write_text("")
    df, counts = steps.ingest(store, "topcv", "company", str(tmp_path / "in.jsonl"), "company_id string, t string")
    assert df.count() == 0 and set(counts.values()) == {0}


@pytest.mark.parametrize("rows_", [[], [("1", "x", 1.5), ("2", None, 1e30), ("x", "2024-01-01", None)]])
def test_conform_counts_what_it_loses(spark, rows_):
    df = spark.createDataFrame(rows_, "id string, day string, pay double")
    lost = Observation()
    wanted = T.StructType.fromDDL("id bigint, day date, pay decimal(10,2), more string")
    out = schema.conform(df, wanted, lost)
    assert out.schema == schema.conform(df, wanted).schema
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, schema.conform(df, wanted).collect()), key=repr)
    assert lost.get == ({"id": 1, "day": 1, "pay": 1} if rows_ else {"id": 0, "day": 0, "pay": 0})
    same = Observation()
    schema.conform(df, df.schema, same).collect()
    assert set(same.get) == {"_none"}


def test_ingest_of_broken_lines_only(spark, store, tmp_path, rows):
    (tmp_path / "in.jsonl").write_text("broken\nagain\n")
    assert steps.run_ingest(store, "topcv", "recruit", str(tmp_path / "in.jsonl")).count() == 0
    assert rows(store.read("raw/topcv/recruit_rejected")) == [("unreadable", "again"), ("unreadable", "broken")]


def test_dated_landing(spark, tmp_path):
    df = spark.createDataFrame([("1", "2024-03-05 10:00:00")], "job_id string, at string")
    jsonl.land_dated(df, str(tmp_path / "raw"), "feed", F.col("at").cast("timestamp"))
    assert os.path.isdir(tmp_path / "raw" / "year=2024" / "month=03" / "day=05" / "spider=feed")
    assert "crawl_timestamp" in spark.read.json(str(tmp_path / "raw")).columns


def test_require_output(spark, tmp_path):
    with pytest.raises(jsonl.MissingOutput):
        jsonl.require_output(spark, str(tmp_path / "none"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    with pytest.raises(jsonl.MissingOutput):
        jsonl.require_output(spark, str(tmp_path / "empty"), "parquet")


def test_profile_is_one_pass(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2)], "s string, n int")
    out = schema.profile(df)
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert rows(out) == [("n", "int", 2, 2), ("s", "string", 2, 1)]


def test_empty_like_has_extra_nullable_columns(spark):
    made = schema.empty_like(spark, T.StructType([T.StructField("a", T.IntegerType(), False)]), {"b": T.StringType()})
    assert made.schema.simpleString() == "struct<a:int,b:string>" and all(f.nullable for f in made.schema.fields)


def test_session_takes_storage_settings_from_the_environment(spark, monkeypatch):
    monkeypatch.setenv("JOBMELD_S3_ENDPOINT", "http://store.example:9000")
    assert session.build_session().conf.get("spark.hadoop.fs.s3a.endpoint") == "http://store.example:9000"


def test_scratch_expires_by_age_and_on_request_only(spark):
    path = session.scratch_path(spark, "old")
    spark.range(3).write.parquet(path)
    assert session.expire_scratch(spark, 3600) == 0 and spark.read.parquet(path).count() == 3
    os.utime(path, (1, 1))
    assert session.expire_scratch(spark, 10**8) >= 1 and not os.path.exists(path)


def test_scratch_is_below_the_shared_folder_of_the_session(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == shared
    assert session.scratch_path(spark, "x").startswith(shared)


def test_sources_name_known_columns():
    names = set(specs.JOB_SCHEMA.names)
    for s in specs.SOURCES.values():
        assert {a for _, a in s.job} <= names
        assert len({a for _, a in s.company}) == len(s.company)


def company(spark, media, data):
    cols = "company_id string, company_name string, company_only_name string, company_address string, province string, ward string, street string, district string"
    return spark.createDataFrame([(i, n, n.lower(), a, *p) for i, n, a, p in data], cols)


@pytest.mark.parametrize("media", sorted(specs.SOURCES))
def test_every_source_feeds_companies(spark, store, media):
    """A full and a sparse company of each source, as its raw schema has them: every mapped value, its quality, its number."""
    spec, schema_ = specs.SOURCES[media], specs.raw_schema(media, "company")
    text = {f.name for f in schema_.fields if f.dataType == T.StringType()}
    row = {f.name: f"{f.name} of A" if f.name in text else None for f in schema_.fields}
    raw = spark.createDataFrame([tuple((row | {"company_id": "a"}).values()), tuple({**dict.fromkeys(row), "company_id": "b"}.values())], schema_)
    store.write(raw, f"raw/{media}/company")
    feed = steps.company_feed(steps._companies(store, spec), None, spec, F.lit("2024-01-01").cast("timestamp"))
    got = {r[spec.id_column]: r for r in feed.collect()}
    assert set(got) == {"a", "b"} and len({r.corporate_number for r in got.values()}) == 2
    # what a source derives from other columns is looked at in the tests of its clean-up
    plain = [(c, m) for c, m in spec.company if c in text and c not in spec.fix_company and c != "company_id"]
    assert len(plain) >= 5
    for column, name in plain:
        assert (got["a"][name], got["a"][f"{name}_quality"]) == (f"{column} of A", spec.quality)
        assert (got["b"][name], got["b"][f"{name}_quality"]) == (None, 0)
    store.merge("master/company", feed, steps.COMPANY_KEYS, steps.survivorship.survive)
    assert store.read("master/company").count() == 2


def test_two_sources_end_to_end(spark, store, rows):
    """The second source finds the company of the first, improves it, and its jobs refer to it."""
    t0, t1 = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-01").cast("timestamp")
    place = ("Hà Nội", "Cống Vị", "1 Kim Mã", "Ba Đình")
    store.write(company(spark, "jobsgo", [("j1", "Mây", "old", place), ("j2", "Gió", "b", ("Huế", "", "", ""))]), "raw/jobsgo/company")
    store.write(spark.createDataFrame([("1", "j1", "Dev", "5")], "job_id string, job_company_id string, job_title string, job_max_salary string"), "raw/jobsgo/recruit")
    steps.run_master(store, "jobsgo", t0)

    store.write(company(spark, "topcv", [("t1", "Mây", "new", place), ("t2", "Nắng", "c", ("", "", "", ""))]), "raw/topcv/company")
    store.write(
        spark.createDataFrame([("9", "t1", "Dev 2", "FULL"), ("8", "gone", "x", "FULL")], "job_id string, job_company_id string, job_title string, job_employment_type string"),
        "raw/topcv/recruit",
    )
    found = steps.run_identify(store, "topcv", t1)
    assert [r["company_id"] for r in found.collect()] == ["t1"]
    steps.run_master(store, "topcv", t1)

    master = {r["standard_name"]: r for r in store.read("master/company").collect()}
    assert set(master) == {"mây", "gió", "nắng"}
    both = master["mây"]
    assert (both["jobsgo_company_id"], both["topcv_company_id"], both["address"], both["address_quality"]) == ("j1", "t1", "new", 30000)
    jobs = steps.read_jobs(store)
    assert rows(jobs.select("media_code", "media_internal_id", "corporate_number")) == [
        ("jobsgo", "1", both["corporate_number"]),
        ("topcv", "9", both["corporate_number"]),
    ]
    assert [r["employment_type"] for r in jobs.filter("media_code = 'topcv'").collect()] == [["FULL"]]
    rich = steps.run_enrich(store)
    assert rows(rich.select("media_code", "edu")) == [("jobsgo", "Đại học"), ("topcv", "Đại học")]
    # a later batch still fits the enriched table and keeps what enrichment added
    steps.run_master(store, "topcv", t1)
    assert "category" in store.read("master/company").columns
    assert store.read("master/recruit/topcv").first()["edu"] == "Đại học"


@pytest.mark.parametrize("media", sorted(specs.SOURCES))
def test_every_source_gives_the_canonical_job_layout(spark, media):
    spec = specs.SOURCES[media]
    raw = spark.createDataFrame([("1", "c1")], "job_id string, job_company_id string")
    master = spark.createDataFrame([("C", "n", "p", "c1")], f"corporate_number string, company_name string, province string, {spec.id_column} string")
    if media in ("timviec365",):
        raw = raw.withColumn("industries", F.array(F.lit("a"), F.lit("b")))
    if media == "vietnamworks":
        raw = raw.withColumn("job_benefits", F.array(F.lit("a"), F.lit("b")))
    if media == "careerviet":
        raw = raw.withColumn("job_salary", F.lit("12.000"))
    if media in ("topcv", "vieclam24h"):
        raw = raw.withColumn("job_employment_type", F.lit("FULL"))
    if media == "vietnamworks":
        raw = raw.withColumn("job_salary_min", F.lit(100000000)).withColumn("job_salary_max", F.lit(200000000))
    out = steps.job_feed(raw, master, spec, F.lit("2024-01-01").cast("timestamp"))
    assert out.drop("created_at", "updated_at").schema.simpleString() == specs.JOB_SCHEMA.simpleString()
    row = out.first()
    assert (row["media_code"], row["corporate_number"], row["province"]) == (media, "C", "p")
    if media == "careerviet":
        assert float(row["max_salary"]) == 12000
    if media == "vietnamworks":
        assert float(row["min_salary"]) == 100000000 and row["benefits"] == "a, b"
    if media == "timviec365":
        assert row["industries"] == "a,b" and row["min_salary"] is None


def test_province_delivered_as_a_struct(spark, store):
    raw = spark.createDataFrame([("1", "A", "a", ("Hà Nội", "x"))], "company_id string, company_name string, company_only_name string, province struct<province:string,street:string>")
    store.write(raw, "raw/careerviet/company")
    out = steps.upsert_companies(store, "careerviet", F.lit("2024-01-01").cast("timestamp"))
    assert out.first()["province"] == "Hà Nội"


@pytest.mark.parametrize("media,kind", [("careerviet", "company"), ("vietnamworks", "recruit"), ("careerlink", "company")])
def test_raw_schema_reads_any_json_shape(spark, tmp_path, media, kind):
    schema_ = specs.raw_schema(media, kind)
    key = steps.KEYS[kind]
    # a number or an object where text is expected comes in as its JSON text
    other = next(f.name for f in schema_.fields if f.name != key and isinstance(f.dataType, T.StringType))
    (tmp_path / "a.jsonl").write_text(f'{{"{key}": 7, "{other}": {{"x": [1]}}}}\n')
    row = jsonl.read_jsonl(spark, str(tmp_path), schema_).first()
    assert str(row[key]) == "7" and row[other] == '{"x": [1]}' and row[jsonl.CORRUPT] is None


def test_extracted_records_fit_the_raw_schemas(spark):
    from jobmeld.operators import extract

    pages = spark.createDataFrame([], "page_id int, url string, html string")
    answers = spark.createDataFrame([], "body string")
    units = spark.createDataFrame([], "level string, name string, district string, province string")
    for media, kind in specs.RAW_COLUMNS:
        src = answers if media == "vietnamworks" else pages
        df = extract.extract_companies(src, media, units) if kind == "company" else extract.extract_jobs(src, media)
        want = specs.raw_schema(media, kind)
        assert set(df.columns) == set(want.names), (media, kind)


def test_run_extract(spark, store, rows):
    html = '<h1 class="company-detail-name text-highlight">Công ty TNHH Mây</h1><div class="desc">1 Kim Mã, Hà Nội</div>'
    pages = spark.createDataFrame([(i, "https://x.vn/may/12.html", html) for i in range(3)], "page_id int, url string, html string")
    units = spark.createDataFrame([("province", "Hà Nội", None, None)], "level string, name string, district string, province string")
    got = steps.run_extract(store, "topcv", "company", pages, units)
    assert rows(got.select("company_id", "company_only_name", "province", "street")) == [("12", "mây", "Hà Nội", "1 Kim Mã")]
    out = steps.upsert_companies(store, "topcv", F.lit("2024-01-01").cast("timestamp"))
    assert rows(out.select("standard_name", "province")) == [("mây", "Hà Nội")]


def test_all_sources_in_one_merge_equal_one_after_the_other(spark, tmp_path, rows):
    when = F.lit("2024-01-01").cast("timestamp")
    stores = [SnapshotStore(spark, str(tmp_path / n)) for n in ("a", "b")]
    place = ("Hà Nội", "", "", "")
    for s in stores:
        s.write(company(spark, "jobsgo", [("j1", "Mây", "old", place), ("j2", "Gió", "", place)]), "raw/jobsgo/company")
        s.write(company(spark, "topcv", [("t1", "Mây", "new", place), ("t2", "Nắng", "c", place)]), "raw/topcv/company")
        s.write(company(spark, "vieclam24h", [("v1", "Mây", "newer", place), ("v2", "Gió", "d", place)]), "raw/vieclam24h/company")
    medias = ["jobsgo", "topcv", "vieclam24h"]
    for m in medias:
        turn = steps.upsert_companies(stores[0], m, when)
    once = steps.upsert_all_companies(stores[1], medias, when)
    assert rows(once.select(*turn.columns)) == rows(turn)
    assert {r["standard_name"]: r["address"] for r in once.collect()} == {"mây": "newer", "gió": "d", "nắng": "c"}
    assert len(stores[1]._complete("master/company")) == 1
