"""URL filter: rules by host and path, and the reputation of the host where no rule fits.

Outcomes of pages, which come from the pages themselves and not from the rules, are summed by host, registered domain
and public suffix. Going down from all pages to suffix, domain and host, each level's rate is shrunk towards its
parent's by a beta prior whose strength is fitted to that level's spread (empirical Bayes). A host is blocked where
its share of bad pages is above the limit even at the lower end of its posterior.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from jobmeld.functions.binding import detached
from jobmeld.llm.common import ascii_lower, stored

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LIMIT = 0.5
SURE = 2.0  # posterior standard deviations
# Words of a URL that mark a page as unwanted, and public suffixes of two labels
BAD_WORDS = ["ads", "adult", "bet", "bets", "casino", "pills", "poker", "porn", "sex", "spam", "xxx"]
SUFFIXES = ["co.uk", "org.uk", "com.au", "co.jp", "co.nz", "co.in", "com.br", "com.vn"]
LEAST_WORDS = 50
_NO_TEXT = r"(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>"


def host_of(url: Column) -> Column:
    """Between the first `://` and the next of / ? #, A-Z in lower case; empty for a null or without `://`."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host to the next of ? #."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule (`host/path…`) that fits, or null. A rule fits its host and all hosts below it."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def outcome(url: Column, html: Column, bad_words: Sequence[str] = BAD_WORDS, least_words: int = LEAST_WORDS) -> Column:
    """Whether a page is bad: its URL holds one of the words between other characters than letters, or its text is short.

    A null page has no text. Null, for a null URL, counts for no rate.
    """
    words = rf"(^|[^a-z])({'|'.join(bad_words)})([^a-z]|$)"
    text = F.regexp_replace(F.coalesce(html, F.lit("")), _NO_TEXT, " ")
    count = F.size(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)))
    return F.when(url.isNotNull(), ascii_lower(url).rlike(words) | (count < least_words))


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest listed suffix that a host has below it, else its last label."""
    found = F.substring_index(host, ".", -1)
    for s in sorted(suffixes, key=len):
        found = F.when(host.endswith("." + s), F.lit(s)).otherwise(found)
    return found


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: a label and the suffix; the host itself where it has no more."""
    labels = F.size(F.split(suffix, r"\."))
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels, F.lit(1)), labels + 1), ".")


def _strength(level: DataFrame) -> float:
    """Prior strength of a level (bad, n, mean): from its rates' spread around their parents' beyond chance.

    Four sums reach the driver. Without spread beyond chance the prior is as strong as all outcomes.
    """
    rate = F.col("bad") / F.col("n")
    noise = F.col("mean") * (1 - F.col("mean"))
    total, nodes, off, by_chance = level.filter("n > 0").agg(
        F.sum("n"), F.count(F.lit(1)), F.sum(F.col("n") * (rate - F.col("mean")) ** 2), F.sum(noise)
    ).first()
    if not nodes:
        return 1.0
    beyond = (off - by_chance) / total
    mean_noise = by_chance / nodes
    return min(max(mean_noise / beyond - 1, 1.0), float(total)) if beyond > 0 else float(total)


def _posterior(level: DataFrame, strength: float) -> Column:
    return (F.col("bad") + strength * F.col("mean")) / (F.col("n") + strength)


def reputation(outcomes: DataFrame, sure: float = SURE, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, n, bad, rate, sure_rate) from `outcomes` (host, bad boolean or null).

    Rows with a null outcome count for no rate; their hosts are judged by domain and suffix. `suffixes` lists those of
    more than one label. One row per host goes through the shared folder.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0).cast("long")).alias("bad")
    )
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host"), suffixes))
    hosts = stored(hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")

    def up(to: str, from_: DataFrame, *more: str) -> DataFrame:
        return from_.groupBy(to, *more).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    n, bad = hosts.agg(F.sum("n"), F.sum("bad")).first()
    overall = ((bad or 0) + 0.5) / ((n or 0) + 1)
    suffixes = up("suffix", hosts).withColumn("mean", F.lit(overall))
    suffixes = suffixes.select("suffix", _posterior(suffixes, _strength(suffixes)).alias("mean"))
    domains = up("domain", hosts, "suffix").join(suffixes, "suffix")
    domains = domains.select("domain", _posterior(domains, _strength(domains)).alias("mean"))
    hosts = hosts.join(domains.select(detached(F.col("domain")).alias("d"), "mean"), F.col("domain") == F.col("d"))
    strength = _strength(hosts)
    rate = _posterior(hosts, strength)
    spread = F.sqrt(rate * (1 - rate) / (F.col("n") + strength + 1))
    return hosts.select("host", "n", "bad", rate.alias("rate"), (rate - sure * spread).alias("sure_rate"))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    limit: float = LIMIT,
    sure: float = SURE,
    bad: Column | None = None,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of `pages` (page_id, url, html).

    `rules` are (`host/path…`, block or allow), a list the caller writes; the longest that fits decides. Other pages
    are blocked where the host's `sure_rate` is above `limit`, else allowed. The outcomes are `bad`, a boolean of a
    page that may be null, by default `outcome` of its URL and text; they count whether a rule fits the page or not,
    and no rule is evidence. Rows without a host share the empty one. Hosts are joined back one row per blocked host;
    a hot host's pages are split by adaptive execution. Repeated rows and null ids give results of their own, very
    long texts are read whole, an empty table gives no rows; other columns, whatever their names, are not read.
    """
    bad = outcome(F.col("url"), F.col("html")) if bad is None else bad
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), bad.alias("bad"))
    host, path = F.col("host"), F.col("path")
    known = reputation(seen.select("host", "bad"), sure, suffixes)
    blocked = known.filter(F.col("sure_rate") > limit).select(detached(host).alias("blocked"))
    out = seen.select("page_id", "host", "path", rule_for(host, path, rules).alias("rule"))
    out = out.join(blocked, host == F.col("blocked"), "left")
    ruled = F.when(F.col("rule").isNotNull(), F.col("rule").isin([r for r, verdict in rules if verdict == "block"]))
    verdict = F.when(F.coalesce(ruled, F.col("blocked").isNotNull()), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
