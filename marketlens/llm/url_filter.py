"""URL filter: fixed rules first, else the reputation of the page's host.

Labelled pages of a host are good or bad outcomes. Few outcomes say little, so each level
borrows from the one above: the corpus, then the suffix, the registered domain, the host.
At each level the children's beta prior has the parent's posterior mean, and a strength
estimated from how much the children differ (method of moments). A host is blocked when the
lower end of its posterior share of bad pages is above a bound. All in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.session import stored

# (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# fixed values: suffixes under which names are registered, beside the last label
SECOND_LEVEL = "co.uk org.uk ac.uk com.au net.au co.jp com.br co.in example.com example.org example.net".split()
# what is left of a character reference at the end of a cut title
_CUT_REFERENCE = r"&(?:a|am|amp|l|lt|g|gt|q|qu|quo|quot|#[xX]?[0-9a-fA-F]{0,3})?\s*\z"
MAX_BAD = 0.5
Z = 1.2816
STRENGTHS = (1.0, 1000.0)


def host_of(url: Column) -> Column:
    """From after the first `://` to the next `/`, `?`, `#` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    found = F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(found, F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host to the next `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path as one text) and its verdict, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for said, at, below in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(below))
        rule, verdict = F.when(fits, at + below).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where names are registered below these."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(SECOND_LEVEL), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label before it."""
    labels = F.size(F.split(suffix_of(host), r"\."))
    return F.when(labels == 2, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def _shrunk(joined: DataFrame, by: str, up: list[str]) -> DataFrame:
    """Posterior alpha, beta and mean of every child in `joined(*up, by, bad, n, mean)`, where
    mean is the parent's posterior mean."""
    # excess of the children's spread over what chance gives, pooled over all parents
    mean, n, bad = F.col("mean"), F.col("n"), F.col("bad")
    moments = joined.agg(
        F.sum(n).alias("n1"), F.sum(n * n).alias("n2"), F.count("*").alias("k"),
        F.sum((bad / n - mean) * (bad / n - mean) * n).alias("spread"),
        F.sum(n * mean * (1 - mean)).alias("chance"),
    ).where("k > 0")
    per_row = F.col("chance") / F.col("n1")
    within = F.greatest((F.col("spread") - per_row * F.col("k")) / F.greatest(F.col("n1") - F.col("k"), F.lit(1.0)), F.lit(0.0))
    strength = F.when(within > 0, per_row / within - 1).otherwise(F.lit(STRENGTHS[1]))
    strength = F.least(F.greatest(strength, F.lit(STRENGTHS[0])), F.lit(STRENGTHS[1]))
    scaled = joined.withColumn("strength", moments.select(strength).scalar())
    alpha, beta = F.col("strength") * mean + bad, F.col("strength") * (1 - mean) + n - bad
    return scaled.select(*up, by, alpha.alias("alpha"), beta.alias("beta"), (alpha / (alpha + beta)).alias("mean"))


def reputations(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """(host, mean, lower, upper) of the share of bad pages, from `outcomes(host, bad, n)`:
    labelled pages and how many were bad, one row per host at most and n > 0."""
    host = F.col("host")
    hosts = outcomes.select(suffix_of(host).alias("suffix"), domain_of(host).alias("domain"), "host", "bad", "n")
    totals = lambda *by: hosts.groupBy(*by).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    # the corpus, with a flat prior
    corpus = hosts.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("mean")).scalar()
    suffixes = _shrunk(totals("suffix").withColumn("mean", corpus), "suffix", []).select("suffix", "mean")
    domains = _shrunk(totals("suffix", "domain").join(suffixes, "suffix"), "domain", ["suffix"])
    parents = domains.select("suffix", "domain", "mean")
    posterior = _shrunk(hosts.join(parents, ["suffix", "domain"]), "host", ["suffix", "domain"])
    a, b = F.col("alpha"), F.col("beta")
    spread = z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return posterior.select("host", "mean", (F.col("mean") - spread).alias("lower"), (F.col("mean") + spread).alias("upper"))


def labelled_pages(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad, n) of the pages whose document is labelled.

    A page shows a document whose first line begins with the page's title, of any length and
    also if it was cut inside a character reference. A line that begins with several titles
    belongs to the longest. A page's outcome is bad when most labelled documents of its title
    are of low quality or toxic.
    """
    bad = ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")
    title = F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1), _CUT_REFERENCE, "")
    for code, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        title = F.replace(title, F.lit(code), F.lit(char))
    shown = pages.select(host_of(F.col("url")).alias("host"), F.trim(title).alias("title")).where("title <> ''")
    # pages of one host and title are counted before the join, so a common title is no hot key
    shown = stored(shown.groupBy("title", "host").agg(F.count("*").alias("n")), "titles")
    sizes = stored(shown.select(F.length("title").alias("size")).distinct(), "title-sizes")
    longest = F.coalesce(sizes.agg(F.max("size")).scalar(), F.lit(0))
    line = F.substr(F.trim(F.substring_index("text", "\n", 1)), F.lit(1), longest)
    lines = (
        labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(bad).alias("bad"))
        .join(docs.select("doc_id", line.alias("line")).where("line <> ''"), "doc_id")
        .groupBy("line").agg(F.sum("bad").alias("bad"), F.count("*").alias("n"))
    )
    every = lines.withColumn("sizes", sizes.agg(F.collect_set("size")).scalar())
    begins = every.select("line", "bad", "n", F.explode("sizes").alias("size")).where(F.col("size") <= F.length("line"))
    begins = begins.select("line", "bad", "n", F.substr(F.col("line"), F.lit(1), F.col("size")).alias("title"))
    titled = (
        begins.join(shown.select("title").distinct(), "title")
        .groupBy("line").agg(F.max(F.struct(F.length("title").alias("size"), "title", "bad", "n")).alias("best"))
        .select("best.title", "best.bad", "best.n")
        .groupBy("title").agg(F.round(F.sum("bad") / F.sum("n")).cast("long").alias("bad"))
    )
    return shown.join(titled, "title").groupBy("host").agg(
        F.sum(F.col("bad") * F.col("n")).alias("bad"), F.sum("n").alias("n")
    )


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD, z: float = Z
) -> DataFrame:
    """Per row of `pages(page_id, url)`: page_id, host, path, rule, verdict, bad_share.

    The verdict is the rule's where one fits, else `block` if the host's posterior share of
    bad pages is above `max_bad` even at the lower end, else `allow`; hosts without labelled
    pages are allowed. A null url, or one without `://`, has empty host and path and no rule.
    Repeated rows stay; other columns are not used.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = reputations(stored(outcomes, "outcomes"), z).select("host", "mean", "lower")
    judged = parts.join(known, "host", "left")
    by_host = F.when(F.col("lower") > max_bad, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        F.col("mean").alias("bad_share"),
    )


