import unicodedata
from decimal import Decimal
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from jobmeld.functions import address, dates, names, numbers, predicates, text as tx, urls


def one(spark, value, fn, ddl="v string"):
    return spark.createDataFrame([(value,)], ddl).select(fn(F.col("v")).alias("o")).first()["o"]


def many(spark, pairs, fn, ddl="i int, v string"):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(pairs)], ddl)
    got = {r["i"]: r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).collect()}
    return [(v, got[i]) for i, (v, _) in enumerate(pairs)]


NAMES = [
    ("CÔNG TY TNHH ABC", "abc"),
    ("Công ty Cổ phần FPT", "fpt"),
    ("CÔNG TY CỔ PHẦN CÔNG TY CP Xyz", "xyz"),
    ("ABC Co., Ltd", "abc"),
    ("ABC Co.,Ltd.", "abc"),
    ("ABC, Ltd", "abc"),
    ("ABC Ltd Co., Ltd.", "abc"),
    ("Samsung Electronics Corporation", "samsung electronics"),
    ("Công ty TNHH MTV Thương Mại (Hà Nội)", "mtv thương mại hà nội"),
    ("  Co Opmart ", "opmart"),
    ("A&B Corp.", "ab"),
    ("Tập đoàn Vingroup - CTCP", "tập đoàn vingroup ctcp"),
    ("Corporation", "corporation"),
    ("ＡＢＣ Co", "co"),
    ("Công ty TNHH　Mây", "tnhh mây"),
    ("", ""),
    (None, ""),
]


def test_name_key(spark):
    assert many(spark, NAMES, names.name_key) == NAMES


def test_name_key_of_decomposed_input_is_composed_but_keeps_its_prefix(spark):
    raw = unicodedata.normalize("NFD", "CÔNG TY TNHH BỆNH VIỆN")
    want = unicodedata.normalize("NFC", "công ty tnhh bệnh viện")
    assert one(spark, raw, names.name_key) == want


def test_name_key_can_drop_bracket_content(spark):
    got = one(spark, "Công ty TNHH Mây (Hà Nội)", lambda c: names.name_key(c, drop_brackets_first=True))
    assert got == "mây"


def test_name_key_of_composed_input_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("a",)], "v string").select(names.name_key(F.col("v"), composed=True))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_fold_text(spark):
    assert one(spark, " ＡＢ  c\n", tx.fold_text) == "ab c"


@pytest.mark.parametrize("raw,want", [("A (b) c (d)", "Ac"), ("(x) y", "y"), ("a (b", "a (b")])
def test_remove_brackets(spark, raw, want):
    assert one(spark, raw, tx.remove_brackets) == want


def test_clean_html(spark):
    assert one(spark, "<li>A &amp; B</li>C<br>D", tx.clean_html) == "- A & B\nC\nD"
    assert one(spark, "&amp;lt; &hellip; &copy", tx.clean_html) == "&lt; … ©"
    assert one(spark, None, tx.clean_html) is None
    assert one(spark, None, tx.clean_html_or_blank) == ""
    assert one(spark, "<br> x <br>", tx.clean_html_or_blank) == "x"


def test_clean_text(spark):
    assert one(spark, " a\r\n\tb c ", tx.clean_text) == "a b c"
    assert one(spark, None, tx.clean_text) == ""


def test_controls_make_json_unreadable_until_removed(spark):
    raw = '{"a":"x\ny"}'
    assert one(spark, raw, lambda c: F.try_parse_json(c).isNull())
    assert one(spark, raw, lambda c: F.try_variant_get(F.try_parse_json(tx.strip_controls(c)), "$.a", "string")) == "xy"


def test_headcount(spark):
    ddl = "v array<string>"
    assert one(spark, ["Hà Nội", " 100-499 nhân viên "], tx.headcount, ddl) == "100-499"
    assert one(spark, ["1 nhân viên", "2 nhân viên"], tx.headcount, ddl) == "2"
    assert one(spark, ["x"], tx.headcount, ddl) == ""
    assert one(spark, None, tx.headcount, ddl) == ""


MONTHS = [
    ('{"e":{"monthsOfExperience":12}}', "12 tháng"),
    ('{"e":"2 năm"}', "2 năm"),
    ('{"e":{}}', "Không rõ"),
    ("{}", "Không rõ"),
    ('{"e":{"monthsOfExperience":0}}', "Không rõ"),
    ("not json", "Không rõ"),
]


def test_months_text(spark):
    assert many(spark, MONTHS, lambda c: tx.months_text(c, "$.e")) == MONTHS


def test_list_or_text(spark):
    pairs = [('{"s":["a","b"]}', "a, b"), ('{"s":"c"}', "c"), ("{}", None)]
    assert many(spark, pairs, lambda c: tx.list_or_text(F.try_parse_json(c), "$.s")) == pairs


def test_opening_hours_keeps_the_last_entry_of_a_day(spark):
    ddl = "v array<struct<dayOfWeek:array<string>,opens:string,closes:string>>"
    value = [(["Mo", "Tu"], "8", "17"), (["Mo"], "9", "12"), (None, "1", "2"), (["We"], None, "5")]
    assert one(spark, value, tx.opening_hours, ddl) == {"Tu": "8 - 17", "Mo": "9 - 12", "We": "None - 5"}
    assert one(spark, [], tx.opening_hours, ddl) == {}


def test_salary(spark):
    pairs = [
        ("12.000.000", Decimal(12000000)),
        ("15,000 000", Decimal(15000000)),
        ("3.000.000.000", Decimal(3000000000)),
        ("Thỏa thuận", None),
        ("", None),
        (".,", None),
        (None, None),
        ("9" * 30, None),
    ]
    assert many(spark, pairs, numbers.salary) == pairs


def test_decimal_that_does_not_fit_is_null(spark):
    assert one(spark, 100000000, lambda c: numbers.to_decimal(c, "decimal(10,2)"), "v bigint") is None
    assert one(spark, 100000000, numbers.to_decimal, "v bigint") == Decimal(100000000)


def test_as_array(spark):
    assert one(spark, "x", numbers.as_array) == ["x"]
    assert one(spark, None, numbers.as_array) is None


def test_has_value(spark):
    df = spark.createDataFrame([("", [], None), (None, None, 0), ("x", [None], 1)], "s string, a array<string>, n int")
    got = df.select(*[predicates.has_value(F.col(f.name), f.dataType) for f in df.schema.fields]).collect()
    assert [tuple(r) for r in got] == [(False, False, False), (False, False, True), (True, True, True)]


LINKS = [
    "http://z/q", "//h/p", "/r?u=1", "?q=2", "#g", "x/y", "../k", "../../../m/", "./", "g;x=1/../y", "..", "",
    "mailto:a@b", "g?y/../x", "/./g/.", "a?b#c",
]


@pytest.mark.parametrize("base", ["http://a.b/c/d/e.html?x=1/2#f", "http://a.b", "https://a.b/", "https://a.b/c/"])
def test_resolve_agrees_with_urljoin(spark, base):
    df = spark.createDataFrame([(base, l) for l in LINKS], "b string, l string")
    got = {r["l"]: r["o"] for r in df.select("l", urls.resolve(F.col("b"), F.col("l")).alias("o")).collect()}
    assert got == {l: urljoin(base, l) for l in LINKS}


def test_ids_from_urls(spark):
    u = "https://x.vn/a-b/tuyen-dung-ke-toan.35C4F2A1.html"
    assert one(spark, u, urls.last_segment) == "tuyen-dung-ke-toan.35C4F2A1.html"
    assert one(spark, u, urls.page_id) == "tuyen-dung-ke-toan.35C4F2A1"
    assert one(spark, u, lambda c: urls.dotted_id(c, -2)) == "35C4F2A1"
    assert one(spark, u, urls.first_token) == "tuyen-dung-ke-toan"
    assert one(spark, "https://x.vn/viec/abc-123", urls.dash_id) == "123"
    assert one(spark, "https://x.vn//", urls.strip_slashes) == "https://x.vn"
    assert one(spark, None, urls.strip_slashes) == ""
    assert one(spark, "x", lambda c: urls.dotted_id(c, -2)) is None


def test_split_address(spark):
    units = spark.createDataFrame(
        [
            ("province", "Hà Nội", None, None),
            ("province", "Huế", None, None),
            ("district", "Quận Ba Đình", None, "Hà Nội"),
            ("ward", "Phường Cống Vị", "Ba Đình", "Hà Nội"),
            ("ward", "Phường Đông", None, "Hà Nội"),
            ("ward", "Phường Đông", None, "Hà Nội"),  # a unit listed twice must not double rows
        ],
        "level string, name string, district string, province string",
    )
    cases = {
        "12 Kim Mã, P. Cống Vị, Quận Ba Đình, TP. Hà Nội": ("12 Kim Mã", "Phường Cống Vị", "Quận Ba Đình", "Hà Nội"),
        "số 5, ngõ 3, phường ĐÔNG, hà nội": ("số 5, ngõ 3", "Phường Đông", None, "Hà Nội"),
        "số 5, Ba Đình, Huế": ("số 5, Ba Đình", None, None, "Huế"),
        "tỉnh Huế": (None, None, None, "Huế"),
        "xyz": ("xyz", None, None, None),
        "": (None, None, None, None),
    }
    df = spark.createDataFrame([(a,) for a in cases], "a string")
    got = {r["a"]: tuple(r["addr"]) for r in address.split_address(df, "a", units).collect()}
    assert got == cases
    loose = units.unionByName(
        spark.createDataFrame([("district", "Phú Quốc", None, None), ("ward", "An Thới", "Phú Quốc", None), ("ward", "Thổ Châu", None, None)], units.schema)
    )
    more = {
        **cases,
        "1 A, An Thới, Phú Quốc": ("1 A", "An Thới", "Phú Quốc", None),
        "1 A, xã Thổ Châu": ("1 A", "Thổ Châu", None, None),
        "An Thới, Huế": ("An Thới", None, None, "Huế"),
        " , ,": (None, None, None, None),
        None: (None, None, None, None),
    }
    df_more = spark.createDataFrame([(a,) for a in more], "a string")
    assert {r["a"]: tuple(r["addr"]) for r in address.split_address(df_more, "a", loose).collect()} == more
    part = address.split_address(df, "a", units).select(
        address.address_part(F.col("addr"), "ward").alias("w"), address.address_part(F.col("addr"), "planet").alias("p")
    )
    assert {r["p"] for r in part.collect()} == {None}


TIMES = [
    ("2024-05-06", "2024-05-06 00:00:00"), ("2024-05-06T07:08:09", "2024-05-06 07:08:09"), ("2024-05-06T07:08:09.123+07:00", "2024-05-06 00:08:09.123"),
    ("06/05/2024", "2024-05-06 00:00:00"), ("06-05-2024", "2024-05-06 00:00:00"), ("06/05/2024 09:10", "2024-05-06 09:10:00"),
    ("1714953600", "2024-05-06 00:00:00"), ("1714953600000", "2024-05-06 00:00:00"), ("31/02/2024", None), ("2024-05-06 x", None), ("", None),
    ("soon", None), (None, None), ("12", None),
]


def test_to_time(spark):
    assert many(spark, TIMES, lambda c: dates.to_time(c).cast("string")) == TIMES
