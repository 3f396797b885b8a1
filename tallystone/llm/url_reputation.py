"""URL filter: rules first, then the empirical-Bayes reputation of the host, in DataFrame functions.

Labelled page outcomes (good or bad) are counted by host. A beta-binomial prior goes down from all hosts to the public
suffix, the registered domain and the host: at each level the prior's mean is the parent's posterior mean and its
weight comes from the children's spread by the method of moments. A host is allowed if its posterior mean less z
posterior standard deviations reaches the threshold. Pages of one host can be a third of all: hosts join by `lookup`.

A rule is "host/path": it fits its host and all subdomains if the url's path starts with the rule's path; the longest
wins. The suffix is the last label, or the last two where they are among `long_suffixes`.

Defined results: a null url or one without "://" has empty host and path, and an empty host is judged as one host;
repeated rows each get their verdict; several outcomes of one page count as one (the worst); an empty table gives an
empty result; without outcomes the prior is one good and one bad page; other columns don't take part.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import lookup, materialize

THRESHOLD, Z = 0.5, 1.645
#: The weight of a prior lies between these numbers of pages.
LEAST, MOST = 1.0, 10_000.0
#: So many parents are sent to all tasks.
FEW = 100_000


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, F.lit("://")) + 3, F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, F.lit("://")) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null. rules: (verdict, "host/path")."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _posterior(rows: DataFrame, key: str) -> DataFrame:
    """(key, a, b): the posterior of each child under its parent's mean m; rows: key, n, good, m. One number comes back."""
    spread = F.col("n") * F.col("m") * (1 - F.col("m"))
    over = F.sum(F.pow(F.col("good") - F.col("n") * F.col("m"), F.lit(2.0)) - spread)
    room = F.sum(spread * (F.col("n") - 1))
    rho = rows.agg(F.when(room > 0, over / room).otherwise(F.lit(0.0)).alias("rho")).first()["rho"]
    k = max(LEAST, min(MOST, 1 / rho - 1)) if rho and rho > 0 else MOST
    return rows.select(key, (F.lit(k) * F.col("m") + F.col("good")).alias("a"), (F.lit(k) * (1 - F.col("m")) + F.col("n") - F.col("good")).alias("b"))


def _under(children: DataFrame, parents: DataFrame, up: str) -> DataFrame:
    """Children with their parent's mean. Few parents are sent to all tasks; of many, those with the most children, so that
    neither a suffix nor a domain that holds a third of all hosts makes a task of its own."""
    kids = children.groupBy(up).agg(F.count("*").alias("kids"))
    facts = materialize(parents.select(up, (F.col("a") / (F.col("a") + F.col("b"))).alias("m")).join(kids, up))
    return children.join(F.broadcast(facts.drop("kids")), up) if facts.count() <= FEW else lookup(children, facts, up, "kids")


def reputation(hosts: DataFrame, long_suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(host, a, b): the Beta posterior of each host. hosts: host, n (labelled pages), good."""
    labels = F.split("host", r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    suffix = F.when(two.isin(*long_suffixes), two).otherwise(F.element_at(labels, -1)) if long_suffixes else F.element_at(labels, -1)
    named = hosts.withColumn("suffix", suffix)
    depth = F.size(F.split("suffix", r"\.")) + 1
    named = named.withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.size(labels) - depth + 1, F.lit(1)), depth), "."))
    by = lambda rows, *keys: rows.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = materialize(by(named, "suffix", "domain"))
    suffixes = materialize(by(domains, "suffix"))
    whole = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    mean = ((whole["good"] or 0.0) + 1) / ((whole["n"] or 0.0) + 2)
    of_suffixes = _posterior(suffixes.withColumn("m", F.lit(mean)), "suffix")
    of_domains = _posterior(materialize(_under(domains, of_suffixes, "suffix")), "domain")
    return _posterior(materialize(_under(named.select("domain", "host", "n", "good"), of_domains, "domain")), "host")


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", threshold: float = THRESHOLD, z: float = Z, long_suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, host, path, rule, verdict, posterior_bound). outcomes: page_id, good (0 or 1)."""
    named = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    one = outcomes.where("page_id is not null and good is not null").groupBy("page_id").agg(F.min("good").alias("good"))
    seen = named.select("page_id", "host").join(one.hint("shuffle_merge"), "page_id", "left")
    hosts = seen.groupBy("host").agg(F.count("*").alias("pages"), F.count("good").cast("double").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"))
    hosts = materialize(hosts)
    beliefs = reputation(hosts.select("host", "n", "good"), long_suffixes)
    mean, total = F.col("a") / (F.col("a") + F.col("b")), F.col("a") + F.col("b")
    bound = mean - z * F.sqrt(mean * (1 - mean) / (total + 1))
    facts = materialize(hosts.select("host", "pages").join(beliefs.hint("shuffle_merge"), "host").select("host", "pages", bound.alias("bound")))
    found = first_rule(F.col("host"), F.col("path"), rules)
    judged = lookup(named, facts, "host", "pages").withColumn("found", found)
    verdict = F.coalesce("found.verdict", F.when(F.col("bound") >= threshold, "allow").otherwise("block"))
    return judged.select("page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), F.round("bound", 6).alias("posterior_bound"))
