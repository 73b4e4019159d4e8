"""URL filter by empirical-Bayes host reputation (DataFrame functions only).

Labelled page outcomes (bad or not) are counted per host.  A host's rate is
shrunk through beta-binomial priors: suffix towards the whole, registered
domain towards its suffix, host towards its domain.  The prior's strength at
each level comes from the counts by the method of moments.  A page is blocked
when the lower posterior bound of its host's bad rate passes a threshold;
fixed allow and block rules come before that.

Scale: pages are aggregated to one row per host before anything is joined
(partial sums, so a host with a third of all pages is no hot group); the
verdict joins back on the host, where AQE may split a hot host's pages.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faro.llm.common import UPPER, cut

# fixed values: (verdict, host and path) of the rules every url is held against first
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
THRESHOLD = 0.5   # block above this bad rate
Z = 1.645         # one-sided 95 % bound
STRENGTH_MIN, STRENGTH_MAX = 1.0, 10000.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or url."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """Registered domain: the last two labels (the host itself if it has fewer)."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent domain and the path's start; nulls if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tested first, so it is wrapped last
        at = text.index("/") if "/" in text else len(text)
        h, p = text[:at], text[at:]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _strength(level: DataFrame) -> float:
    """Method-of-moments strength of the beta prior from rows (n, k, p): trials, bad ones, the parent's mean."""
    n, k, p = F.col("n").cast("double"), F.col("k").cast("double"), F.col("p")
    s = level.filter("n > 0").agg(F.sum((k - n * p) * (k - n * p) - n * p * (1 - p)).alias("over"),
                                  F.sum(n * (n - 1) * p * (1 - p)).alias("room")).first()
    if not s["room"]:
        return STRENGTH_MAX
    rho = s["over"] / s["room"]
    return STRENGTH_MAX if rho <= 0 else min(max(1 / rho - 1, STRENGTH_MIN), STRENGTH_MAX)


def reputation(counts: DataFrame, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """Per host of ``counts(host, n, k)``: posterior mean, standard deviation and lower bound of the bad rate.

    Only the three strengths (one number a level) pass through the driver.
    """
    counts = cut(counts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "k"))
    total = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    root = ((total["k"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    suffix = counts.groupBy("suffix").agg(*sums).withColumn("p", F.lit(root))
    s0 = _strength(suffix)
    shrunk = lambda s: ((F.col("k") + s * F.col("p")) / (F.col("n") + s))
    suffix = suffix.select("suffix", shrunk(s0).alias("p"))
    domain = counts.groupBy("domain", "suffix").agg(*sums).join(suffix, "suffix")
    s1 = _strength(domain)
    domain = domain.select("domain", shrunk(s1).alias("p"))
    host = counts.join(domain, "domain")
    s2 = _strength(host)
    mean = shrunk(s2)
    sd = F.sqrt(mean * (1 - mean) / (F.col("n") + s2 + 1))
    return host.select("host", F.col("n").alias("n_labelled"), F.col("k").alias("n_bad"), mean.alias("bad_rate"), (mean - z * sd).alias("bad_bound")) \
               .withColumn("by_host", F.when(F.col("bad_bound") > threshold, "block").otherwise("allow"))


def judge(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url",
          rules: Sequence[tuple[str, str]] = RULES, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """One row per page: (page_id, host, path, rule, verdict, n_labelled, n_bad, bad_rate).

    ``outcomes`` has (page_id, bad): any number of labelled outcomes per page
    (a null ``bad`` is no outcome, an outcome of no page or of a null id is
    left out).  Urls that are null or lack ``://`` have empty host and path;
    they share one (empty) host's reputation.  Repeated pages are judged each
    and count each.  With no outcome at all every rate is one half and nothing
    is blocked but by rule.  Other columns are not read.
    """
    p = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    per_page = outcomes.filter("bad is not null and page_id is not null").groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("k"))
    counts = p.join(per_page, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    return p.join(reputation(counts, threshold, z), "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, "by_host").alias("verdict"), "n_labelled", "n_bad", "bad_rate")


def outcomes_from_labels(labels: DataFrame) -> DataFrame:
    """Outcome of the page with a label's id: bad when of low quality or toxic; null when neither is known."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return labels.select(F.col("doc_id").alias("page_id"), F.when(known, bad).alias("bad"))


def oracle() -> str:
    """DuckDB SQL for the query ``op2_url_reputation`` (same formulas)."""
    low = f"translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{UPPER.lower()}')"
    cases_r, cases_v = "", ""
    for kind, text in sorted(RULES, key=lambda r: (len(r[1]), r[1]), reverse=True):
        at = text.index("/")
        fits = f"(host = '{text[:at]}' OR ends_with(host, '.{text[:at]}')) AND starts_with(path, '{text[at:]}')"
        cases_r += f" WHEN {fits} THEN '{text}'"
        cases_v += f" WHEN {fits} THEN '{kind}'"

    def strength(src: str) -> str:
        over, room = "sum((k - n * p) * (k - n * p) - n * p * (1 - p))", "sum(n * (n - 1.0) * p * (1 - p))"
        return (f"(SELECT CASE WHEN coalesce({room}, 0) = 0 OR {over} / {room} <= 0 THEN {STRENGTH_MAX} "
                f"ELSE least(greatest(1 / ({over} / {room}) - 1, {STRENGTH_MIN}), {STRENGTH_MAX}) END FROM {src} WHERE n > 0)")

    return f"""WITH p AS (SELECT page_id, coalesce({low}, '') AS host,
 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (SELECT doc_id AS page_id, count(*) AS n, count_if(coalesce(quality = 0, false) OR coalesce(toxic = 1, false)) AS k FROM labels
 WHERE (quality IS NOT NULL OR toxic IS NOT NULL) AND doc_id IS NOT NULL GROUP BY 1),
c AS (SELECT host, CAST(coalesce(sum(n), 0) AS DOUBLE) AS n, CAST(coalesce(sum(k), 0) AS DOUBLE) AS k,
 array_to_string(string_split(host, '.')[-2:], '.') AS domain, string_split(host, '.')[-1] AS suffix FROM p LEFT JOIN o USING (page_id) GROUP BY host),
r AS (SELECT (coalesce(sum(k), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) AS p FROM c),
s AS (SELECT suffix, sum(c.n) AS n, sum(c.k) AS k, (SELECT p FROM r) AS p FROM c GROUP BY suffix),
s0 AS (SELECT {strength('s')} AS st), s1 AS (SELECT suffix, (k + st * p) / (n + st) AS p FROM s, s0),
d AS (SELECT domain, suffix, sum(c.n) AS n, sum(c.k) AS k, any_value(s1.p) AS p FROM c JOIN s1 USING (suffix) GROUP BY domain, suffix),
d0 AS (SELECT {strength('d')} AS st), d1 AS (SELECT domain, (k + st * p) / (n + st) AS p FROM d, d0),
h AS (SELECT host, c.n, c.k, d1.p FROM c JOIN d1 USING (domain)),
h0 AS (SELECT {strength('h')} AS st), h1 AS (SELECT host, n, (k + st * p) / (n + st) AS m, st FROM h, h0),
v AS (SELECT host, CASE WHEN m - {Z} * sqrt(m * (1 - m) / (n + st + 1)) > {THRESHOLD} THEN 'block' ELSE 'allow' END AS by_host FROM h1)
SELECT page_id, host, path, CASE{cases_r} END AS rule, CASE{cases_v} ELSE by_host END AS verdict FROM p JOIN v USING (host)"""
