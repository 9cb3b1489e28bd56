"""What keeps a figure from growing faster than the input."""

from pyspark.sql import functions as F

from jobmeld.operators import extract, incremental
from jobmeld.operators.markup import El, Field, Page
from jobmeld.plans import steps
from jobmeld.queries import lookalikes
from jobmeld.sources.store import BUCKET, SnapshotStore


def _tables(spark, path):
    keys = spark.range(240).selectExpr("IF(id % 4 = 0, NULL, id) AS c_custkey", "id % 25 AS c_nationkey", "'A' AS c_mktsegment", "id AS s_suppkey")
    keys.coalesce(1).write.parquet(f"{path}/customer.parquet")
    keys.coalesce(1).write.parquet(f"{path}/supplier.parquet")
    spark.range(25).selectExpr("id AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{path}/nation.parquet")
    return str(path)


def _tasks(df):
    return df.groupBy(F.spark_partition_id()).count().select("count").collect()


def test_one_file_of_customers_gives_pages_in_many_tasks(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    for pages in (lookalikes.markup_pages, lookalikes.trap_pages, lookalikes.profile_pages, lookalikes.list_pages):
        df = pages(spark, sf)
        counts = [r[0] for r in _tasks(df)]
        assert sum(counts) == 240 and df.filter("page_id IS NULL").count() == 60
        assert max(counts) < 60, pages


def test_one_file_of_companies_is_keyed_in_many_tasks(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    for companies in (lookalikes.raw_companies, lookalikes.master_companies):
        assert max(r[0] for r in _tasks(companies(spark, sf))) < 60, companies


def test_keys_are_counted_without_a_join(spark):
    entries = spark.createDataFrame(
        [(1, "a", "", "", "raw", "r1"), (1, "a", "", "", "master", "m1"), (1, "b", "", "", "raw", "r2"), (1, "c", "", "", "raw", "r3"), (1, "c", "", "", "master", "m3")],
        incremental._NO_ENTRIES,
    )
    keys = spark.createDataFrame([(1, "a", "", ""), (1, "b", "", ""), (1, "gone", "", "")], "method int, _k1 string, _k2 string, _k3 string")
    got = incremental._counted(entries, keys)
    assert sorted(tuple(r)[1::3] + (r.corporate_number,) for r in got.collect()) == [("a", "r1", "m1"), ("b", None, None), ("gone", None, None)]
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_a_row_by_row_change_leaves_rows_in_their_buckets(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), buckets=4)
    rows = spark.range(100).selectExpr("CAST(id AS STRING) AS k", "id AS v")
    store.write_buckets(rows, "t", ["k"])
    seen = []
    out = store.rewrite("t", lambda t: seen.append(t) or t.withColumn("v", F.col("v") + 1), ["k"])
    assert sorted((r.k, r.v) for r in out.collect()) == sorted((str(i), i + 1) for i in range(100))
    assert len(seen) == 1 and len(store.bucket_folders("t")) == 4
    store.merge("t", spark.createDataFrame([("7", 0)], "k string, v long"), ["k"], incremental._replaced(["k"], "v"))
    assert store.read("t").filter("k = '7'").collect()[0].v == 0 and store.read("t").count() == 100
    assert all(b.startswith(tuple("0123")) for b in store.bucket_folders("t")) and BUCKET not in out.columns


def test_a_new_table_takes_its_batch_without_a_copy(spark, tmp_path, monkeypatch):
    from jobmeld.sources import store as module

    monkeypatch.setattr(module, "scratch_path", lambda *a: (_ for _ in ()).throw(AssertionError("written aside")))
    store = SnapshotStore(spark, str(tmp_path / "s"), buckets=4)
    batch = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "media_internal_id string, v int")
    out = store.merge("t", batch, steps.JOB_KEYS, lambda d, s: steps.upsert.upsert_stored(d, s, steps.JOB_KEYS))
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 2)]
    files = [p.name for p in tmp_path.rglob("*.parquet")]
    assert files and all(".zstd." in f for f in files)


def test_attributes_are_read_only_where_a_selector_can_fit():
    page = Page("<p class=x id=i>a</p>" * 50 + '<p class="z y">b</p><p class="&#121;">c</p><b>d</b>')
    assert page.take(Field(El(css="y"))) == ["b", "c"] and len(page._attrs) == 2
    assert page.take(Field(El("p", css="y", within=El("p", ident="&")))) == [] and len(page._attrs) == 2


def test_a_selector_without_words_fits_what_has_no_attributes():
    page = Page('<p>a</p><p class="x">b</p><p href="">c</p>')
    assert page.take(Field(El("p", css=""))) == page.take(Field(El("p", css_part=""))) == ["a", "b", "c"]
    assert page.take(Field(El("p", attr_part=("href", "")))) == ["a", "b", "c"] and page.take(Field(El("p", attrs=(("href", ""),)))) == ["c"]


def test_labels_sought_among_the_same_elements_read_them_once(monkeypatch):
    seen = {"attrs": [], "text_of": []}
    for name, found in seen.items():
        monkeypatch.setattr(Page, name, lambda self, e, of=getattr(Page, name), found=found: found.append(e) or of(self, e))
    page = Page('<p class="x item_if"> Độ \n tuổi</p><span>9</span><p class="item_if">Giới <b>tính</b></p><span>Nam</span>' * 50)
    got = [page.take(Field(extract.beside(label, css="item_if"))) for label in ("Độ tuổi", "Giới tính", "Bằng cấp", "Quy mô")]
    assert got == [["9"] * 50, ["Nam"] * 50, [], []]
    # a text that stands in several elements is put together anew, so that what is kept is no more than the page
    assert len(seen["attrs"]) == 100 and len(seen["text_of"]) == 50 + 4 * 50 + 100 and len(page._flat) == 50


def test_a_word_that_the_page_does_not_hold_reads_only_what_is_written_with_entities():
    page = Page('<p class="a">1</p>' * 50 + '<p class="&#122;">2</p>' + '<b class="&#122;">3</b>')
    assert page.take(Field(El("p", css="z"))) == ["2"] and page.take(Field(El(css_part="z"))) == ["2", "3"] and len(page._attrs) == 2
