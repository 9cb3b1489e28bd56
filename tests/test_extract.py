import json

from pyspark.sql import functions as F

from jobmeld.operators import extract as ex, markup

PAGES = "page_id int, url string, html string"


def pages(spark, *htmls, url="https://x.vn/a/job-7.35F2.html"):
    return spark.createDataFrame([(i, url, h) for i, h in enumerate(htmls)], PAGES)


def block(doc):
    text = doc if isinstance(doc, str) else json.dumps(doc, ensure_ascii=False)
    return f'<html><script type="application/ld+json">{text}</script></html>'


def test_block_with_line_breaks_inside_strings(spark):
    raw = '{"@type": "JobPosting",\n"title": "Nhân viên\n\tkinh doanh", "baseSalary": {"value": {"minValue":12000000}}}'
    row = ex.jsonld_blocks(pages(spark, block(raw))).select(ex.at("title").alias("t"), ex.at("baseSalary.value.minValue", "bigint").alias("n")).first()
    assert tuple(row) == ("Nhân viênkinh doanh", 12000000)


def test_broken_block_gives_nulls_and_other_blocks_are_left_out(spark):
    p = pages(spark, block("{JobPosting"), block({"@type": "WebSite"}), "", None)
    got = ex.jsonld_blocks(p).select("page_id", "doc").collect()
    assert [(r["page_id"], r["doc"]) for r in got] == [(0, None)]


def test_location_as_list_object_or_nothing(spark):
    a = {"address": {"streetAddress": "s", "postalCode": "p"}}
    p = pages(spark, *[block({"@type": "JobPosting", **d}) for d in ({"jobLocation": [a]}, {"jobLocation": a}, {"jobLocation": []}, {})])
    got = ex.jsonld_blocks(p).select("page_id", ex.location("streetAddress").alias("s")).collect()
    assert {r["page_id"]: r["s"] for r in got} == {0: "s", 1: "s", 2: None, 3: None}


def test_experience_forms(spark):
    p = pages(
        spark,
        *[block({"@type": "JobPosting", **d}) for d in (
            {"experienceRequirements": {"monthsOfExperience": 12}}, {"experienceRequirements": "2 năm"}, {"experienceRequirements": {}}, {})],
    )
    got = {r["page_id_"]: r["job_exp_requirement"] for r in ex.job_postings(p.withColumn("url", F.concat(F.lit("https://x.vn/a-"), "page_id")), "jobsgo")
           .withColumn("page_id_", F.col("job_id")).collect()}
    assert got == {"0": "12 tháng", "1": "2 năm", "2": "Không rõ", "3": "Không rõ"}


def test_every_posting_source_has_its_columns(spark):
    p = pages(spark, block({"@type": "JobPosting", "title": "T"}))
    for media, n in (("careerviet", 23), ("jobsgo", 18), ("topcv", 25), ("vieclam24h", 21)):
        df = ex.job_postings(p, media)
        assert len(df.columns) == n and df.count() == 1


def test_company_without_url_has_no_id(spark):
    p = pages(spark, block({"@type": "JobPosting", "hiringOrganization": {"name": "Công ty TNHH A"}}), block({"@type": "JobPosting"}))
    got = sorted(tuple(r) for r in ex.posting_companies(p).select("company_name", "company_id", "company_only_name").collect())
    assert got == [("", None, None), ("Công ty TNHH A", None, "a")]


def test_state_companies_skips_pages_without_state(spark):
    state = {"props": {"initialState": {"api": {"employerDetail": {"data": {"id": 5, "name": "CÔNG TY CP B"}}}}}}
    script = f'<script id="__NEXT_DATA__" type="application/json">{json.dumps(state)}</script>'
    p = pages(spark, script + '<div class="truncate" title="x"></div><div title="https://b.vn" class="truncate">b</div>', "<p>")
    got = ex.state_companies(p).collect()
    assert [(r["company_id"], r["company_only_name"], r["company_slug"], r["company_domain"]) for r in got] == [("5", "b", "", "https://b.vn")]


def test_api_answers(spark):
    body = {"meta": {"nbPages": 2}, "data": [{"jobId": 1, "skills": [{"skillName": "x"}, {}], "companyName": None}, {"jobId": 2}]}
    df = spark.createDataFrame([(json.dumps(body),), ("{}",), ("broken",)], "body string")
    jobs = {r["job_id"]: r for r in ex.api_jobs(df).collect()}
    assert jobs[1]["job_skills"] == ["x", ""] and jobs[2]["job_skills"] == [] and jobs[2]["job_description"] == ""
    assert [r["industry"] for r in ex.api_companies(df).collect()] == ["", ""]
    assert sorted(r["page"] for r in ex.page_numbers(df).collect()) == [0, 0, 0, 1, 1, 1, 2]


def test_labelled_values_in_nested_markup(spark):
    html = """
      <div class="element_detail"><div><span>Quy <b>x</b></span><span>Quy mô:</span></div><div><p>10 &ndash; 50<br> <b>người</b></p></div></div>
      <div class="element_detail"><span>Email</span><p>Email: </p><p>a@b.vn</p></div>
      <div class="other"><span>Website</span><p>no</p></div>
      <p>after</p><div class="element_detail"><span>Open</span><p>end"""
    got = markup.labelled_values(pages(spark, html, None), ["Quy mô", "Email", "Website", "Open"]).collect()
    assert tuple(got[0])[2:] == ("10 – 50 người", "a@b.vn", "", "end")
    assert tuple(got[1])[2:] == ("", "", "", "")


def test_tags(spark):
    html = '<h1 id="job-title">A &amp; b</h1><a class="x employer" href="/1">n</a><a class="employer job-company-name" title="t" href="/2">Co</a><link href="/c" rel="canonical">'
    c = F.col("html")
    row = pages(spark, html).select(
        ex.tag_text(c, "h1", "job-title", "id").alias("a"),
        ex.tag_text(c, "a", "employer job-company-name").alias("b"),
        ex.tag_attr(c, "a", "href", "employer job-company-name").alias("c"),
        ex.tag_attr(c, "link", "href", "canonical", "rel").alias("d"),
        ex.tag_text(c, "h2").alias("e"),
    ).first()
    assert tuple(row) == ("A & b", "Co", "/2", "/c", None)


def test_links(spark):
    html = '<a href="/b">1</a><a class="k" href="https://y.vn/z">2</a><a href="/b">3</a><a href="?page=2" rel="next">n</a><abbr href="/no">'
    p = pages(spark, html)
    assert sorted(r["link"] for r in ex.outgoing(p).collect()) == ["https://x.vn/a/job-7.35F2.html?page=2", "https://x.vn/b", "https://y.vn/z"]
    assert [r["link"] for r in ex.outgoing(p, "y.vn").collect()] == ["https://y.vn/z"]
    row = p.select(
        ex.next_page(F.col("url"), F.col("html")).alias("n"), ex.last_link(F.col("html")).alias("l"), F.size(ex.first_links(F.col("html"), 2)).alias("f")
    ).first()
    assert tuple(row) == ("https://x.vn/a/job-7.35F2.html?page=2", "?page=2", 2)
    pager = pages(spark, '<li class="next-page"><a href="/p/2">x</a></li>', "<p>")
    assert {r["page_id"]: r["n"] for r in pager.select("page_id", ex.next_page(F.col("url"), F.col("html")).alias("n")).collect()} == {0: "https://x.vn/p/2", 1: None}


def test_parent_context(spark):
    p = spark.createDataFrame(
        [(1, "https://x.vn/cat", '<h1>IT</h1><a href="/job/1">a</a><a href="/job/9">b</a>'), (2, "https://x.vn/job/1", "<h1>Dev</h1>")], PAGES
    )
    got = sorted(tuple(r) for r in ex.with_parent_context(p, ex.tag_text(F.col("html"), "h1")).collect())
    assert got == [(1, "https://x.vn/job/1", "IT", 2), (1, "https://x.vn/job/9", "IT", None)]


def test_markup_jobs_of_one_source(spark):
    html = """
      <h1 class="x com_post y" data-id=" 77 ">Kế toán <b>trưởng</b> &amp; thuế</h1><p class="a mluong">10 triệu</p>
      <a class="com_name" href="https://x.vn/cong-ty/may-9"><p class="com_name_text"> Công ty Mây </p></a>
      <p class="index">Ngành nghề: <a class="tag">Kế toán</a><a class="tag">Thuế</a></p><p class="index">Lĩnh vực: <a class="tag">Dịch vụ</a></p>
      <span class="diachi"> Hà  Nội </span>
      <p class="item_if">Hình thức làm việc</p><span>Toàn thời gian</span><p class="item_if">- Số lượng cần tuyển:</p> <span> 3 <i>người</i></span>
      <p class="item_if">Bằng cấp</p><span>Đại học</span>
      <div><h2 class="tit_detail_post">Mô tả công việc</h2></div><div class="text_content"><div>a</div><ul><li>b</li></ul></div><div class="text_content">other</div>
      <div class="box ycau_tdung"><div><p>r1</p></div> r2 </div>
      <div><h2 class="tit_detail_post">Quyền lợi</h2></div><div class="text_content">g</div>"""
    r = ex.extract_jobs(pages(spark, html), "timviec365").first().asDict()
    assert (r["job_id"], r["job_title"], r["job_salary"]) == ("77", "Kế toán trưởng & thuế", "10 triệu")
    assert (r["job_company_name"], r["job_company_id"], r["address"]) == ("Công ty Mây", "may-9", "Hà Nội")
    assert (r["industries"], r["fields"]) == (["Kế toán", "Thuế"], ["Dịch vụ"])
    assert (r["job_employment_type"], r["headcount"], r["degree"], r["age"]) == ("Toàn thời gian", "3 người", "Đại học", "")
    assert (r["job_description"], r["requirements"], r["benefits"]) == ("a\nb", "r1\n r2 ", "g")


def test_markup_jobs_of_another_source(spark):
    html = """
      <h1 id="job-title">Dev</h1><a href="/viec-lam-cua/may/55" title="Mây"><img src="x"></a><span class="text-primary">Thương lượng</span>
      <div id="job-location"><span>1 Kim Mã</span>,  <b>Hà Nội</b></div><i class="cli cli-suitcase-simple d"></i> <span>2 năm</span>
      <div><div id="job-description"><h5>Mô tả</h5></div><div><p>x</p><p>y</p></div><div>no</div></div>
      <div id="section-job-benefits"><div class="job-benefit-item">i<span>Bảo hiểm</span></div><div class="job-benefit-item"><span>Thưởng</span></div></div>
      <div id="section-job-skills"><div class="raw-content rich-text-content"><p>* Kỹ năng</p><p>SQL</p></div></div>
      <div class="job-summary-item d-block"><div>Ngành nghề</div><a href="#"><span>CNTT</span></a><a href="#"><span>Điện</span></a></div>
      <div>Loại công việc</div> <div> Chính thức </div><div>Học vấn</div><div>Cao đẳng</div>"""
    r = ex.extract_jobs(pages(spark, html, url="https://x.vn/tim-viec/dev/301"), "careerlink").first().asDict()
    assert (r["job_id"], r["job_title"], r["job_company_id"], r["job_company_name"]) == ("301", "Dev", "55", "Mây")
    assert (r["job_location"], r["job_experience_requirement"], r["job_salary"]) == ("1 Kim Mã , Hà Nội", "2 năm", "Thương lượng")
    assert (r["job_description"], r["job_benefits"], r["job_skills"], r["job_industry"]) == ("x\ny", "Bảo hiểm Thưởng", ["SQL"], "CNTT, Điện")
    assert (r["job_employment_type"], r["job_education_requirements"], r["job_position"]) == ("Chính thức", "Cao đẳng", "")


def test_markup_companies(spark):
    top = """<h1 class="company-detail-name text-highlight">Công ty TNHH Mây</h1><div class="desc"> 1 Kim Mã,
      Hà Nội </div><div class="content"><div><p>a</p></div><p>b</p>c</div>
      <div class="company-subdetail-info website"><i></i><a target="_blank" href="https://may.vn//">x</a></div>
      <span class="company-subdetail-info-text">Hà Nội</span><span class="company-subdetail-info-text"> 25-99 nhân viên </span>"""
    units = spark.createDataFrame([("province", "Hà Nội", None, None)], "level string, name string, district string, province string")
    r = ex.extract_companies(pages(spark, top, url="https://x.vn/cong-ty/may/12.html"), "topcv", units).first().asDict()
    assert (r["company_id"], r["company_only_name"], r["company_domain"], r["company_size"]) == ("12", "mây", "https://may.vn", "25-99")
    assert (r["company_description"], r["company_address"], r["province"], r["street"]) == ("b", "1 Kim Mã, Hà Nội", "Hà Nội", "1 Kim Mã")

    go = """<link rel="canonical" href="https://x.vn/c/9"><meta property="og:description" content="about">
      <div class="company-name"><h1>Công ty CP Gió (Gio JSC)</h1></div><span class="company-category-list"><a><span>CNTT</span></a></span>
      <div class="get-touch"><li><i class="pb-heroicons-map-pin"></i><span>Huế</span></li><li><i class="x pb-heroicons-globe-alt"></i> <a href="http://gio.vn">g</a></li></div>"""
    r = ex.extract_companies(pages(spark, go, url="https://x.vn/tuyen-dung/gio-9"), "jobsgo").first().asDict()
    assert (r["company_id"], r["company_name"], r["company_only_name"]) == ("gio-9", "Công ty CP Gió", "gió")
    assert (r["company_address"], r["company_domain"], r["company_industry"], r["company_description"]) == ("Huế", "http://gio.vn", "CNTT", "about")

    tim = """<a class="name_com" href="https://x.vn/may"><h1> Công ty  Mây </h1></a>
      <div class="element_detail"><span>Quy mô</span><p>10 người</p></div><div class="element_detail"><span>Trụ sở chính</span><p>1 Kim Mã</p></div>"""
    r = ex.extract_companies(pages(spark, tim, url="https://x.vn/may-3"), "timviec365").first().asDict()
    assert (r["company_id"], r["company_only_name"], r["company_scale"], r["company_address"], r["tax_code"]) == ("may-3", "mây", "10 người", "1 Kim Mã", "")


def test_values_stay_in_their_element(spark):
    """No site of its own, but links elsewhere on the page; entities; any quoting; classes in any order."""
    foot = '<footer><a href="https://facebook.com/board">f</a></footer><h1>Related jobs</h1>'
    go = """<div class='company-name'></div><div class="company-name"><h1>R&amp;D A &amp; B</h1></div><div class="get-touch">
      <li><i class="pb-heroicons-globe-alt"></i>none</li><li><a href="https://x.vn/login">l</a></li></div>"""
    r = ex.extract_companies(pages(spark, go + foot), "jobsgo").first().asDict()
    assert (r["company_name"], r["company_domain"]) == ("R&D A & B", None)
    r = ex.extract_companies(pages(spark, '<div class="company-name"></div>' + foot), "jobsgo").first().asDict()
    assert r["company_name"] is None
    own = "<div class='get-touch'><li><i class='pb-heroicons-globe-alt'></i><a href='http://a.vn/?x=1&amp;y'>a</a></li></div>"
    assert ex.extract_companies(pages(spark, own + foot), "jobsgo").first()["company_domain"] == "http://a.vn/?x=1&y"
    top = "<div class='website company-subdetail-info'>{}</div>" + foot
    for inner, want in (("", ""), ("<a href=http://t.vn/>t</a>", "http://t.vn")):
        assert ex.extract_companies(pages(spark, top.format(inner)), "topcv").first()["company_domain"] == want


def test_implausible_page_counts_give_no_pages(spark):
    rows = [(i, f'{{"meta":{{"nbPages":{n}}}}}') for i, n in enumerate([2, 2_000_000_000, 100_001, 0])]
    got = ex.page_numbers(spark.createDataFrame(rows, "i int, body string")).collect()
    pages_of = {i: [r["page"] for r in got if r["i"] == i] for i in range(4)}
    assert pages_of == {0: [0, 1, 2], 1: [None], 2: [None], 3: [0]}


def test_links_in_any_quoting(spark):
    html = """<a href='/x?a=1&amp;b=2'>1</a><a class=k href=/y>2</a><A HREF = "/z">3</A><a href="">4</a><a title="href='/no'">5</a>"""
    assert pages(spark, html).select(ex.page_links(F.col("html")).alias("l")).first()["l"][:4] == ["/x?a=1&b=2", "/y", "/z", ""]


def test_sections_of_one_class_stay_apart(spark):
    box = '<div class="raw-content rich-text-content"><p>{}</p></div>'
    html = f"""<div id="section-job-description">{box.format("about")}</div><div id="section-job-skills">{box.format("SQL")}</div>
      <div class="job-benefit-item"><span>no</span></div><div id="section-job-benefits"><div class="job-benefit-item"><span>yes</span></div></div>"""
    r = ex.extract_jobs(pages(spark, html, url="https://x.vn/tim-viec/dev/301"), "careerlink").first()
    assert (r["job_skills"], r["job_benefits"]) == (["SQL"], "yes")


def test_blocks_in_any_quoting(spark):
    block = '{"@type":"JobPosting","title":"Dev","skills":["a","b"]}'
    html = "".join(f"<script class='x' type={t}>{block}</script>" for t in ("'application/ld+json'", "application/ld+json", '"application/ld+json" id="q"'))
    assert ex.jsonld_blocks(pages(spark, html)).count() == 3
    assert ex.job_postings(pages(spark, html), "careerviet").first()["job_skills"] == "a, b"
