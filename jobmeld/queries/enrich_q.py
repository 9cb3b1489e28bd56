"""Education, classification, snapping, scorers."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmeld.operators import enrich
from jobmeld.queries.base import query, table


def sql_case(rules, default) -> str:
    arms = " ".join(f"WHEN regexp_matches(text, '(?i){p}') THEN '{l}'" for l, p in rules)
    return f"CASE {arms} ELSE '{default}' END"


_EDU = sql_case(enrich.EDUCATION_RULES, enrich.EDUCATION_DEFAULT)


@query("enr1_education", f"SELECT doc_id, {_EDU} AS edu FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", enrich.education(F.col("text")).alias("edu"))


@query(
    "flt5_case_chain",
    f"SELECT conv_id, turn, {sql_case([('THPT', 'th.n|ph')], 'Đại học')} AS edu FROM conversations",
)
def _(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", enrich.education(F.col("text"), [("THPT", "th.n|ph")]).alias("edu")
    )


_WORDS = "SELECT doc_id, concat(' ', trim(regexp_replace(lower(text), '[^\\p{L}\\p{M}\\p{N}]+', ' ', 'g')), ' ') AS w FROM documents"


# rules over words that the given texts hold; the default rules are about job posts
LANGUAGE_RULES: enrich.Rules = {
    "English": ["the", "of", "and", "that", "with"],
    "German": ["der", "die", "und", "nicht"],
    "French": ["le", "les", "des", "une"],
    "Spanish": ["el", "los", "que", "una"],
}
CATEGORIES = {**enrich.CATEGORY_RULES, **LANGUAGE_RULES}
INDUSTRIES = {**enrich.INDUSTRY_RULES, **LANGUAGE_RULES}
SKILLS = {**enrich.SKILL_RULES, **LANGUAGE_RULES}


def _hits(keywords) -> str:
    return "(" + " + ".join(f"contains(w, ' {k} ')::INT" for k in keywords) + ")"


def sql_single(rules) -> str:
    h = ", ".join(f"{_hits(k)} AS h{i}" for i, k in enumerate(rules.values()))
    top = "greatest(" + ", ".join(f"h{i}" for i in range(len(rules))) + ")"
    arms = " ".join(f"WHEN h{i} = {top} THEN '{l}'" for i, l in enumerate(rules))
    return f"SELECT doc_id, CASE WHEN {top} = 0 THEN NULL {arms} END AS label FROM (SELECT doc_id, {h} FROM ({_WORDS}))"


def sql_multi(rules) -> str:
    parts = ", ".join(f"CASE WHEN {_hits(k)} > 0 THEN '{l}' END" for l, k in rules.items())
    return f"SELECT doc_id, nullif(concat_ws(', ', {parts}), '') AS skills FROM ({_WORDS})"


@query("enr2_category", sql_single(CATEGORIES))
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", enrich.classify_single(F.col("text"), CATEGORIES).alias("label"))


@query("enr3_industry", sql_single(INDUSTRIES))
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", enrich.classify_single(F.col("text"), INDUSTRIES).alias("label"))


@query("enr4_skills", sql_multi(SKILLS))
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", enrich.classify_multi(F.col("text"), SKILLS).alias("skills"))


@query(
    "enr5_prompt",
    "SELECT item_id, concat('Name the one label from the list that fits the text best.', chr(10), 'Labels:', chr(10), "
    + ", chr(10), ".join(f"'- {l}'" for l in enrich.JOB_CATEGORIES)
    + ", chr(10), 'Answer with labels only.', chr(10), 'Text:', chr(10), text) AS prompt FROM benchmark",
)
def _(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", enrich.prompt(F.col("text"), enrich.JOB_CATEGORIES).alias("prompt"))


_LABELS = ", ".join(f"({i}, '{l}')" for i, l in enumerate(enrich.JOB_CATEGORIES))
_ANSWER = "CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN concat(' Heal', p_size, 'thcare ') ELSE concat(p_type, ' and finance') END"
_NEAR = f"""SELECT p_partkey, arg_min(label, d * 100 + i) AS label, min(d) AS d FROM (
  SELECT p_partkey, i, label, levenshtein(lower(trim({_ANSWER})), lower(label)) AS d FROM part, (VALUES {_LABELS}) t(i, label)) GROUP BY p_partkey"""


@query("enr6_snap", f"SELECT p_partkey, label FROM ({_NEAR})")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", enrich.snap(F.expr(_ANSWER), enrich.JOB_CATEGORIES).alias("label"))


@query("enr6_snap_near", f"SELECT p_partkey, CASE WHEN d <= 6 THEN label END AS label FROM ({_NEAR})")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", enrich.snap(F.expr(_ANSWER), enrich.JOB_CATEGORIES, 6).alias("label"))


# ---- pluggable scorers ------------------------------------------------------------------------------
def _by_length(text, limit=200, least=5):
    n = len(text.split())
    if n < least:
        raise ValueError(f"{n} words")
    return "long" if n > limit else "short"


_N = "len(list_filter(string_split_regex(text, '\\s+'), lambda s: s <> ''))"


def _old(df):
    return df.withColumn("expertise", F.when(F.col("doc_id") % 5 == 0, F.lit("given")))


@query("udf1_scorer", f"SELECT doc_id, CASE WHEN {_N} > 200 THEN 'long' WHEN {_N} >= 5 THEN 'short' END AS label FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", enrich.scorer_udf(_by_length)(F.col("text"))["label"].alias("label"))


@query(
    "udf2_scorer_settings",
    f"""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'given' WHEN {_N} > 50 THEN 'long' WHEN {_N} >= 1 THEN 'short' END AS expertise FROM documents""",
)
def _(spark, sf):
    docs = _old(table(spark, sf, "documents").select("doc_id", "text"))
    return enrich.score_texts(docs, "text", _by_length, "expertise", limit=50, least=1).select("doc_id", "expertise")


@query(
    "udf3_scorer_errors",
    f"""SELECT doc_id, CASE WHEN {_N} > 200 THEN 'long' WHEN {_N} >= 30 THEN 'short' END AS label,
          CASE WHEN {_N} < 30 THEN concat('ValueError: ', {_N}, ' words') END AS label_error FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return enrich.score_texts(docs, "text", _by_length, "label", least=30).select("doc_id", "label", "label_error")
