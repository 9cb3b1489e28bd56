"""Education level, closed-label classification, answer snapping, pluggable scorers.

The default scorer is a table of keywords per label, evaluated as a native expression on the row:
nothing is shuffled and nothing leaves the JVM. A costly scorer (a model, a remote service) goes
through `score_texts`, which runs it once per distinct text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from jobmeld.functions.binding import bind
from jobmeld.functions.text import words

# Education rules, first hit wins, and the level where none hits
EDUCATION_RULES = [
    ("THCS", "THCS|Cấp 2|Trung học Cơ sở|TH Cơ sở|secondary"),
    ("THPT", "THPT|Trung học Phổ Thông|cấp 3|TH Phổ thông|phổ thông| high school"),
    ("Trung cấp", "Trung cấp|tc"),
    ("Cao đẳng", "Cao đẳng|cđ"),
    ("Đại học", "Cử nhân|kĩ sư|college|Bachelor|degree|majors|University"),
]
EDUCATION_DEFAULT = "Đại học"

# The closed label lists, in order
JOB_CATEGORIES = [
    "Information Technology (IT)",
    "Business and Finance",
    "Healthcare",
    "Education",
    "Engineering",
    "Culture - Creativity",
    "Legal",
    "Customer Service",
    "Agriculture and Environment",
    "Sales",
    "Food and Beverage",
    "Media",
]
COMPANY_INDUSTRIES = [
    "Công nghệ thông tin (IT)",
    "Sản xuất",
    "Tài chính và ngân hàng",
    "Thương mại điện tử",
    "Dịch vụ chuyên môn",
    "Xây dựng và bất động sản",
    "Y tế và dược phẩm",
    "Giáo dục và đào tạo",
    "Vận tải và logistics",
    "Năng lượng và tài nguyên",
    "Nông nghiệp",
    "Du lịch và khách sạn",
    "Tiêu dùng",
    "Truyền thông và giải trí",
    "Môi trường và bảo vệ thiên nhiên",
]
SKILLS = [
    "Ngoại ngữ",
    "Kỹ năng văn phòng",
    "Kỹ năng công nghệ thông tin (IT)",
    "Kỹ năng cơ khí/điện",
    "Kỹ năng thiết kế đồ họa",
    "Kỹ năng kế toán",
    "Kỹ năng quản lý dự án",
    "Kỹ năng phân tích dữ liệu",
    "Giao tiếp",
    "Làm việc nhóm",
    "Giải quyết vấn đề",
    "Quản lý thời gian",
    "Lãnh đạo",
    "Quản lý xung đột",
    "Tư duy phản biện",
    "Tạo động lực",
    "Tự học và thích ứng",
    "Quản lý nhân sự",
    "Quản lý tài chính",
    "Quản lý chiến lược",
    "Sáng tạo nội dung",
    "Nghiên cứu và phát triển (R&D)",
    "Bán hàng",
    "Tiếp thị kỹ thuật số",
    "Dịch vụ khách hàng",
    "Thuyết trình",
    "Lắng nghe",
    "Quan hệ đối ngoại",
    "Nghiên cứu thị trường",
    "Phân tích dữ liệu",
    "Quản lý vận hành",
    "Quản lý chuỗi cung ứng",
    "Quản lý cơ sở dữ liệu",
    "Phát triển phần mềm",
    "Bảo mật mạng",
]

Rules = Mapping[str, Sequence[str]]

# Keywords per label: whole words or word groups, lower case. Label order breaks ties.
CATEGORY_RULES: Rules = {
    "Information Technology (IT)": ["it", "software", "developer", "lập trình", "phần mềm", "cntt", "công nghệ thông tin"],
    "Business and Finance": ["finance", "accounting", "bank", "kế toán", "tài chính", "ngân hàng", "kinh doanh", "kiểm toán"],
    "Healthcare": ["health", "medical", "hospital", "y tế", "dược", "bệnh viện", "chăm sóc sức khỏe"],
    "Education": ["education", "teacher", "school", "giáo dục", "đào tạo", "giáo viên", "giảng viên"],
    "Engineering": ["engineer", "engineering", "mechanical", "cơ khí", "kỹ thuật", "xây dựng", "điện tử"],
    "Culture - Creativity": ["design", "art", "creative", "thiết kế", "sáng tạo", "nghệ thuật", "mỹ thuật"],
    "Legal": ["legal", "law", "luật", "pháp lý", "pháp chế"],
    "Customer Service": ["customer", "chăm sóc khách hàng", "lễ tân", "dịch vụ khách hàng"],
    "Agriculture and Environment": ["agriculture", "farm", "environment", "nông nghiệp", "lâm nghiệp", "môi trường"],
    "Sales": ["sales", "retail", "bán hàng", "bán lẻ", "tư vấn bán hàng"],
    "Food and Beverage": ["food", "restaurant", "bếp", "nhà hàng", "thực phẩm", "đồ uống"],
    "Media": ["media", "news", "marketing", "truyền thông", "báo chí", "quảng cáo"],
}
INDUSTRY_RULES: Rules = {
    "Công nghệ thông tin (IT)": ["it", "software", "phần mềm", "công nghệ thông tin"],
    "Sản xuất": ["sản xuất", "nhà máy", "gia công", "manufacturing"],
    "Tài chính và ngân hàng": ["tài chính", "ngân hàng", "bảo hiểm", "bank", "finance"],
    "Thương mại điện tử": ["thương mại điện tử", "sàn thương mại", "e commerce"],
    "Dịch vụ chuyên môn": ["tư vấn", "kiểm toán", "luật"],
    "Xây dựng và bất động sản": ["xây dựng", "bất động sản", "construction", "real estate"],
    "Y tế và dược phẩm": ["y tế", "dược phẩm", "bệnh viện", "pharma"],
    "Giáo dục và đào tạo": ["giáo dục", "đào tạo", "trường học", "education"],
    "Vận tải và logistics": ["vận tải", "vận chuyển", "logistics", "kho bãi"],
    "Năng lượng và tài nguyên": ["năng lượng", "dầu khí", "khoáng sản", "energy"],
    "Nông nghiệp": ["nông nghiệp", "chăn nuôi", "thủy sản"],
    "Du lịch và khách sạn": ["du lịch", "khách sạn", "hotel", "travel"],
    "Tiêu dùng": ["tiêu dùng", "bán lẻ", "siêu thị", "retail"],
    "Truyền thông và giải trí": ["truyền thông", "giải trí", "quảng cáo", "media"],
    "Môi trường và bảo vệ thiên nhiên": ["môi trường", "xử lý nước", "rác thải", "environment"],
}
SKILL_RULES: Rules = {
    "Ngoại ngữ": ["tiếng anh", "tiếng nhật", "tiếng trung", "tiếng hàn", "ngoại ngữ", "english", "ielts", "toeic"],
    "Kỹ năng văn phòng": ["tin học văn phòng", "excel", "word", "powerpoint"],
    "Kỹ năng công nghệ thông tin (IT)": ["công nghệ thông tin", "it", "mạng máy tính"],
    "Kỹ năng cơ khí/điện": ["cơ khí", "điện", "bảo trì máy"],
    "Kỹ năng thiết kế đồ họa": ["thiết kế đồ họa", "photoshop", "illustrator"],
    "Kỹ năng kế toán": ["kế toán", "báo cáo thuế", "accounting"],
    "Kỹ năng quản lý dự án": ["quản lý dự án", "project management"],
    "Kỹ năng phân tích dữ liệu": ["phân tích dữ liệu", "data analysis", "sql"],
    "Giao tiếp": ["giao tiếp", "communication"],
    "Làm việc nhóm": ["làm việc nhóm", "teamwork"],
    "Giải quyết vấn đề": ["giải quyết vấn đề", "xử lý tình huống", "problem solving"],
    "Quản lý thời gian": ["quản lý thời gian", "time management"],
    "Lãnh đạo": ["lãnh đạo", "leadership"],
    "Quản lý xung đột": ["quản lý xung đột", "giải quyết xung đột"],
    "Tư duy phản biện": ["tư duy phản biện", "critical thinking"],
    "Tạo động lực": ["tạo động lực", "truyền cảm hứng"],
    "Tự học và thích ứng": ["tự học", "thích ứng", "ham học hỏi"],
    "Quản lý nhân sự": ["quản lý nhân sự", "tuyển dụng", "nhân sự"],
    "Quản lý tài chính": ["quản lý tài chính", "ngân sách"],
    "Quản lý chiến lược": ["chiến lược", "strategy"],
    "Sáng tạo nội dung": ["sáng tạo nội dung", "viết bài", "content"],
    "Nghiên cứu và phát triển (R&D)": ["nghiên cứu và phát triển", "r d"],
    "Bán hàng": ["bán hàng", "telesales", "sales"],
    "Tiếp thị kỹ thuật số": ["tiếp thị kỹ thuật số", "digital marketing", "seo"],
    "Dịch vụ khách hàng": ["dịch vụ khách hàng", "chăm sóc khách hàng"],
    "Thuyết trình": ["thuyết trình", "presentation"],
    "Lắng nghe": ["lắng nghe"],
    "Quan hệ đối ngoại": ["đối ngoại", "quan hệ công chúng"],
    "Nghiên cứu thị trường": ["nghiên cứu thị trường", "market research"],
    "Phân tích dữ liệu": ["phân tích số liệu", "phân tích dữ liệu"],
    "Quản lý vận hành": ["vận hành", "operations"],
    "Quản lý chuỗi cung ứng": ["chuỗi cung ứng", "supply chain", "kho vận"],
    "Quản lý cơ sở dữ liệu": ["cơ sở dữ liệu", "database", "sql server", "mysql"],
    "Phát triển phần mềm": ["phát triển phần mềm", "lập trình", "software"],
    "Bảo mật mạng": ["bảo mật", "an ninh mạng", "security"],
}


def education(col: Column, rules: Sequence[tuple[str, str]] = EDUCATION_RULES, default: str = EDUCATION_DEFAULT, flags: str = "(?i)") -> Column:
    """Education level asked for in a text (ENR1, FLT5, FN8).

    The plain flags ignore the case of ASCII letters only; pass "(?iu)" to ignore it for all.
    """
    first, *others = rules
    level = F.when(col.rlike(flags + first[1]), first[0])
    for label, pattern in others:
        level = level.when(col.rlike(flags + pattern), label)
    return level.otherwise(default)


def _found(col: Column, rules: Rules) -> Column:
    """Distinct keywords of all rules that occur in the text as whole words, in one regex pass.

    Each word is tried as the start of a keyword, longest first. A keyword that begins another one
    ("sql", "sql server") is implied by the longer.
    """
    keywords = sorted({k for ks in rules.values() for k in ks}, key=lambda k: (-len(k), k))
    begins = {k: [p for p in keywords if k == p or k.startswith(p + " ")] for k in keywords}
    hits = F.regexp_extract_all(words(col), F.lit(f" (?=({'|'.join(keywords)}) )"), F.lit(1))
    if any(len(ps) > 1 for ps in begins.values()):
        table = F.create_map(*[x for k, ps in begins.items() for x in (F.lit(k), F.array(*[F.lit(p) for p in ps]))])
        hits = F.flatten(F.transform(F.array_distinct(hits), lambda k: F.element_at(table, k)))
    return F.array_distinct(hits)


def _count(found: Column, keywords: Sequence[str]) -> Column:
    return F.size(F.array_intersect(found, F.array(*[F.lit(k) for k in keywords])))


def classify_single(col: Column, rules: Rules) -> Column:
    """The label with the most keywords in the text, the first such label on a tie (ENR2, ENR3).

    Null for a null text or when no keyword occurs.
    """
    def best(found: Column) -> Column:
        scores = [
            F.struct((-_count(found, ks)).alias("n"), F.lit(i).alias("i"), F.lit(label).alias("label"))
            for i, (label, ks) in enumerate(rules.items())
        ]
        return F.when(F.size(found) > 0, F.array_min(F.array(*scores))["label"])

    return bind(_found(col, rules), best)


def classify_multi(col: Column, rules: Rules, sep: str = ", ") -> Column:
    """All labels with a keyword in the text, in rule order, joined; null when none (ENR4)."""
    def labels(found: Column) -> Column:
        hit = [F.when(_count(found, ks) > 0, F.lit(label)) for label, ks in rules.items()]
        return F.when(F.size(found) > 0, F.concat_ws(sep, *hit))

    return bind(_found(col, rules), labels)


def prompt(col: Column, labels: Sequence[str], many: bool = False) -> Column:
    """Instruction, label list and row text as one string (ENR5)."""
    task = (
        "Name every label from the list that applies to the text, separated by commas."
        if many
        else "Name the one label from the list that fits the text best."
    )
    head = f"{task}\nLabels:\n" + "\n".join(f"- {l}" for l in labels) + "\nAnswer with labels only.\nText:\n"
    return F.concat(F.lit(head), F.coalesce(col, F.lit("")))


def snap(col: Column, labels: Sequence[str], max_distance: int | None = None) -> Column:
    """The label nearest to an answer by edit distance, the first such label on a tie (ENR6).

    Case and outer blanks do not count. With `max_distance`, an answer further away gives null.
    """
    answer = F.lower(F.trim(col))
    near = F.array_min(
        F.array(
            *[
                F.struct(F.levenshtein(answer, F.lit(l.lower())).alias("d"), F.lit(i).alias("i"), F.lit(l).alias("label"))
                for i, l in enumerate(labels)
            ]
        )
    )
    ok = col.isNotNull() if max_distance is None else col.isNotNull() & (near["d"] <= max_distance)
    return F.when(ok, near["label"])


def scorer_udf(score: Callable[..., str | None], **settings) -> Callable[[Column], Column]:
    """Wrap a text -> label function as an Arrow UDF giving struct(label, error) (UDF1-UDF3).

    Settings travel in the closure; pass what the function needs, secrets come from its own
    environment. A failing row yields a null label and its error text, never an error as label.
    """
    def one(text):
        try:
            return score(text, **settings), None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    @F.pandas_udf("label string, error string")
    def run(texts: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if t is None else one(t) for t in texts]
        return pd.DataFrame(rows, columns=["label", "error"], dtype=object)

    return run


def score_texts(df: DataFrame, text: str, score: Callable[..., str | None], out: str, **settings) -> DataFrame:
    """Fill `out` (and `{out}_error`) by a costly scorer, run once per distinct text (FLT3, FLT4, UDF1).

    Rows that have a label already, or no text, do not reach the scorer. Distinct texts and the join
    back go by the sha-256 of the text. The join shuffles the rows with the columns that the caller keeps,
    the text among them if it is kept; select narrow columns first where that matters.
    """
    run = scorer_udf(score, **settings)
    has_old = out in df.columns
    todo = F.col(text).isNotNull()
    if has_old:
        todo = todo & F.col(out).isNull()
    # rows without work get a key of their own content, so that they spread over the join's tasks
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType) and not isinstance(f.dataType, T.VariantType)]
    idle = F.concat(F.lit("-"), F.xxhash64(*plain).cast("string"))
    keyed = df.withColumn("_h", F.when(todo, F.sha2(F.col(text), 256)).otherwise(idle))
    scored = (
        keyed.filter(todo)
        .groupBy("_h")
        .agg(F.min(text).alias("_t"))
        .select(F.col("_h").alias("_k"), run(F.col("_t")).alias("_s"))
    )
    kept = [c for c in df.columns if c not in (out, f"{out}_error")]
    label = F.col("_s.label")
    return keyed.join(scored, F.col("_h") == F.col("_k"), "left").select(
        *kept,
        (F.coalesce(F.col(out), label) if has_old else label).alias(out),
        F.col("_s.error").alias(f"{out}_error"),
    )
