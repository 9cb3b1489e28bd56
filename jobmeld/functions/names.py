"""Company-name key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from jobmeld.functions.text import WS, compose, remove_brackets, squeeze, trim_ws

# Legal forms before and after a company name, in the order they are taken off.
PREFIXES = [
    "công ty trách nhiệm hữu hạn",
    "công ty tnhh",
    "công ty cổ phần",
    "công ty cp",
    "công ty",
    "company",
    "corporation",
    "co",
]
SUFFIXES = [
    r"co\.?,?\s?ltd\.?",
    "limited",
    "corporation",
    r"corp\.?",
    r"ltd\.?",
]
# Fixed value: characters a key may hold besides white space
KEPT = "0-9a-zA-ZÀ-ỹ"

# Every form may come off once, in list order, so the leading forms are one run of optional groups
# from the start of the name, and the trailing forms one run, last form first, up to its end.
_LEAD = "(?iu)^" + "".join(f"(?:{p}[{WS}]+)?" for p in PREFIXES)
# the look-ahead lets the scan pass over places where no form can begin
_TAIL = (
    f"(?iu)(?=[{WS},][{WS}]*[{''.join(sorted({s[0] for s in SUFFIXES}))}])"
    + "".join(f"(?:(?:[{WS}]+|,[{WS}]*){s})?".replace(r"\s?", f"[{WS}]?") for s in reversed(SUFFIXES))
    + "$"
)


def name_key(col: Column, drop_brackets_first: bool = False, composed: bool = False) -> Column:
    """The comparable core of a company name: no legal form, no punctuation, lower case (NRM1).

    Null gives "". `composed=True` promises input in composed Unicode form (see `text.compose`),
    which keeps the whole expression in the JVM.
    """
    name = trim_ws(F.coalesce(col, F.lit("")))
    if drop_brackets_first:
        name = remove_brackets(name)
    name = F.regexp_replace(F.regexp_replace(name, _LEAD, ""), _TAIL, "")
    name = F.regexp_replace(name, f"[^{KEPT}{WS}]", "")
    if not composed:
        name = compose(name)
    return F.lower(F.trim(squeeze(name)))
