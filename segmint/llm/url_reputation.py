"""URL filters by empirical-Bayes host reputation.

Labelled outcomes of pages are shrunk through beta-binomial priors: a suffix
towards the overall rate, a registered domain towards its suffix, a host
towards its domain. How strongly each level shrinks is estimated from the
spread of its members' rates. A host is blocked when the lower bound of its
posterior share of bad pages exceeds a limit. Rules come before the method.
All of it is grouping and joins on narrow columns.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmint.llm.text import lower_az
from segmint.session import materialize


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


RULES = (Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
         Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"))
#: Names under which a country registers domains, so that ``co.uk`` or ``com.mx`` is a public suffix, and sites whose
#: users have a name each. All other suffixes are the last name alone.
SECOND_NAMES = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "gv", "ltd", "mil", "ne", "net", "or", "org", "plc", "sch")
SHARED_SITES = ("azurewebsites.net", "blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "vercel.app", "web.app",
                "wordpress.com")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to ``/``, ``?``, ``#`` or the end with A-Z
    lowered; then up to ``?``, ``#`` or the end. Both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_az(host), path


def _country_suffix(second: tuple[str, ...]) -> str:
    return rf"^({'|'.join(second)})\.[a-z][a-z]$"


def domain_and_suffix(host: Column, second: tuple[str, ...] = SECOND_NAMES, shared: tuple[str, ...] = SHARED_SITES) -> tuple[Column, Column]:
    """The registered domain and its public suffix, without user and port; an
    address of numbers is its own domain under the empty suffix. A suffix has
    two names where one of ``second`` stands before a country's two letters,
    or where it is one of ``shared``."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    address = name.rlike(r"^[0-9.]+$") | name.startswith("[")
    last2 = F.substring_index(name, ".", -2)
    two = last2.rlike(_country_suffix(second)) | last2.isin(*shared)
    suffix = F.when(address, "").when(two, last2).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(address, name).when(two, F.substring_index(name, ".", -3)).otherwise(last2)
    return domain, suffix


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits, null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule, verdict = F.when(fits, r.host + r.path).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, parent: str) -> DataFrame:
    """One row: m, the prior's weight in pages, by the method of moments: the
    correlation of outcomes inside a child beyond its parent's rate."""
    totals = children.groupBy(parent).agg(F.sum("n").alias("pn"), F.sum("k").alias("pk"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                                          F.count(F.lit(1)).alias("c")).where("pn > 0")
    rate = F.col("pk") / F.col("pn")
    spread = (children.where("n > 0").join(totals, parent)
              .agg(F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - rate, 2)).alias("s")))
    whole = children.where("n > 0").join(totals, parent).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("c"), F.countDistinct(parent).alias("p"),
        F.sum(F.col("n") * F.col("n") / F.col("pn")).alias("w"),
        F.sum(F.col("n") * rate * (1 - rate)).alias("v"))
    v = F.col("v") / F.col("n")  # mean binomial variance
    free = F.col("n") - F.col("w") - (F.col("c") - F.col("p"))
    rho = F.when((F.col("v") > 0) & (free > 0), (F.col("s") / v - (F.col("c") - F.col("p"))) / free)
    m = 1 / F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1e-4)), F.lit(0.5)) - 1
    return whole.crossJoin(spread).select(m.alias("m"))  # one row with one row


def reputations(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, domain, suffix, n, k, mean, bound) from (host, n, k): posterior
    mean of the share of bad pages and its lower bound, the mean less ``z``
    standard deviations of the beta posterior, 0 at least."""
    domain, suffix = domain_and_suffix(F.col("host"))
    h = materialize(hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix")), "url-hosts")
    d = materialize(h.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "url-domains")
    s = materialize(d.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).withColumn("root", F.lit(0)), "url-suffixes")
    root = s.agg(((F.sum("k") + 0.5) / (F.sum("n") + 1)).alias("prior"))
    s = s.crossJoin(root).crossJoin(_strength(s, "root")).select(  # one row each
        "suffix", ((F.col("k") + F.col("m") * F.col("prior")) / (F.col("n") + F.col("m"))).alias("prior"))
    d = d.join(s, "suffix").crossJoin(_strength(d, "suffix")).select(
        "domain", "suffix", ((F.col("k") + F.col("m") * F.col("prior")) / (F.col("n") + F.col("m"))).alias("prior"))
    a, b = F.col("k") + F.col("m") * F.col("prior"), F.col("n") - F.col("k") + F.col("m") * (1 - F.col("prior"))
    mean = a / (a + b)
    out = h.join(d, ["domain", "suffix"]).crossJoin(_strength(h, "domain"))
    return out.select("host", "domain", "suffix", "n", "k", mean.alias("mean"),
                      F.greatest(F.lit(0.0), mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url", outcome_id: str = "page_id",
               bad_col: str = "bad", most: float = 0.5, rules: tuple[Rule, ...] = RULES, z: float = 1.645) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_bound) for every row of ``pages``.

    A rule's verdict holds, the longest if several fit; else a url is blocked
    if its host's lower bound of bad pages is over ``most``. An id labelled
    more than once is bad if one label says so; null ids or labels are not
    used. A null url or one without ``://`` has an empty host and path, and is
    judged like any host. Repeated rows each get their row. Other columns are
    not read. Without labels the bound follows an even prior; empty tables
    give an empty table.
    """
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    p = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    o = outcomes.select(F.col(outcome_id).alias("id"), F.col(bad_col).cast("int").alias("bad")).where("id is not null and bad is not null")
    o = o.groupBy("id").agg(F.max("bad").alias("bad"))
    known = p.select("page_id", "host").join(o, F.col("page_id") == F.col("id"), "left")
    hosts = known.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
    found = materialize(reputations(hosts, z).select("host", F.col("bound").alias("bad_bound")), "url-reputations")
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    return p.join(found, "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bad_bound") > most, "block").otherwise("allow")).alias("verdict"), "bad_bound")


def url_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The thin query: a page is bad if the label of its number is of low
    quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    return judge_urls(pages, labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))).drop("bad_bound")


def _strength_sql(children: str, parent: str) -> str:
    return f"""(SELECT 1 / least(greatest(coalesce(CASE WHEN v > 0 AND n - w - (c - p) > 0 THEN (s / (v / n) - (c - p)) / (n - w - (c - p)) END, 0), 1e-4), 0.5) - 1
 FROM (SELECT sum(x.n) n, count(*) c, count(DISTINCT x.{parent}) p, sum(x.n * x.n / t.n) w, sum(x.n * (t.k / t.n) * (1 - t.k / t.n)) v,
   sum(x.n * pow(x.k / x.n - t.k / t.n, 2)) s
  FROM {children} x JOIN (SELECT {parent}, sum(n) n, sum(k) k FROM {children} GROUP BY 1) t USING ({parent}) WHERE x.n > 0))"""


def _case_sql(value: Callable[[Rule], str]) -> str:
    """The value of the longest rule that fits."""
    whens = " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{value(r)}'"
                     for r in sorted(RULES, key=lambda r: -len(r.host + r.path)))
    return f"CASE {whens} END"


ORACLE = f"""
WITH split AS (
 SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
 FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages)),
named AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM split),
parts AS (
 SELECT *, string_split(name, '.') AS names, regexp_matches(name, '^[0-9.]+$') OR starts_with(name, '[') AS address,
  regexp_matches(array_to_string(list_slice(string_split(name, '.'), -2, -1), '.'), '{_country_suffix(SECOND_NAMES)}')
    OR array_to_string(list_slice(string_split(name, '.'), -2, -1), '.') IN ({', '.join(repr(x) for x in SHARED_SITES)}) AS two FROM named),
registered AS (
 SELECT page_id, host, path, CASE WHEN address THEN '' WHEN two THEN array_to_string(list_slice(names, -2, -1), '.') ELSE names[-1] END AS suffix,
  CASE WHEN address THEN name WHEN two THEN array_to_string(list_slice(names, -3, -1), '.') ELSE array_to_string(list_slice(names, -2, -1), '.') END AS domain
 FROM parts),
bad AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 0 END) AS bad FROM labels GROUP BY 1),
h AS (SELECT host, domain, suffix, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS k
 FROM registered LEFT JOIN bad ON doc_id = page_id GROUP BY 1, 2, 3),
d AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY 1, 2),
s AS (SELECT suffix, 0 AS root, sum(n) AS n, sum(k) AS k FROM d GROUP BY 1),
sp AS (SELECT suffix, (k + m * (SELECT (sum(k) + 0.5) / (sum(n) + 1) FROM s)) / (n + m) AS prior FROM s, (SELECT {_strength_sql('s', 'root')} AS m)),
dp AS (SELECT domain, suffix, (k + m * prior) / (n + m) AS prior FROM d JOIN sp USING (suffix), (SELECT {_strength_sql('d', 'suffix')} AS m)),
hp AS (SELECT host, k + m * prior AS a, n - k + m * (1 - prior) AS b FROM h JOIN dp USING (domain, suffix), (SELECT {_strength_sql('h', 'domain')} AS m)),
bound AS (SELECT host, greatest(0, a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) AS bound FROM hp)
SELECT page_id, host, path, {_case_sql(lambda r: r.host + r.path)} AS rule,
 coalesce({_case_sql(lambda r: r.verdict)}, CASE WHEN bound > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM registered JOIN bound USING (host)
"""
