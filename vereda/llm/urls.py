"""URL verdicts: listed rules first, then the reputation of the host by empirical Bayes.

Labelled pages of a host are beta-binomial outcomes. The rate of a host is shrunk towards
its registered domain, that towards its suffix, and that towards all pages; how strongly is
estimated from the spread at each level. Native expressions only, so the same in SQL.
"""

from pyspark.sql import DataFrame, functions as F

# The rules a query must apply, longest match first.
RULES = [
    ("example.net/en/", "example.net", "/en/", "allow"),
    ("example.com/de/", "example.com", "/de/", "block"),
    ("org/fr/", "org", "/fr/", "allow"),
    ("net/", "net", "/", "block"),
]
# Suffixes of two labels below which domains are registered.
SUFFIXES = [
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.in", "co.jp", "co.kr",
    "co.nz", "co.za", "com.ar", "com.br", "com.cn", "com.mx", "com.tr",
]
Z = 1.645  # one-sided 95 % bound
LIMIT = 0.5  # a host whose bad rate is above this, by its lower bound, is blocked
WEAKEST, STRONGEST = 1.0, 10000.0  # range of the prior's weight in pages


def split_url(url):
    """Host and path of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)"))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        "abcdefghijklmnopqrstuvwxyz",
    )
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def host_levels(host, suffixes=SUFFIXES):
    """Registered domain and suffix of a host, without user part and port.

    The suffix is the last label, or the last two where ``suffixes`` lists them, and the domain
    has one label more. An address is its own domain, under a suffix of all addresses.
    """
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":[0-9]*$", "")
    address = bare.rlike(r"^([0-9]+\.){3}[0-9]+$") | bare.startswith("[")
    wide = F.substring_index(bare, ".", -2).isin(list(suffixes))
    domain = F.when(address, bare).otherwise(
        F.when(wide, F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    )
    last = F.when(wide, F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1))
    return domain, F.when(address, F.lit("[]")).otherwise(last)


def document_of(path):
    """The number of the document that a path such as /en/7817.html shows, else null."""
    number = F.regexp_extract(path, r"^/[a-z]{2}/([0-9]+)(?:/|\.html)?$", 1)
    return number.try_cast("bigint")  # no number, or one too long for an id, is null


def rule_of(host, path, rules=RULES):
    """The rule that fits, longest first, and its verdict."""
    name = verdict = None
    for rule, domain, prefix, says in sorted(rules, key=lambda rule: -len(rule[0])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        name = F.when(fits, F.lit(rule)) if name is None else name.when(fits, F.lit(rule))
        verdict = F.when(fits, F.lit(says)) if verdict is None else verdict.when(fits, F.lit(says))
    return name, verdict


def _rates(counts, level, parent):
    """Posterior rate of each ``level``, given rows with the posterior of their ``parent``.

    The prior's weight comes from the intra-class correlation: the spread of the rates
    around their parents beyond what the number of pages explains.
    """
    seen = counts.filter("n > 0").select(
        "n", (F.col("b") / F.col("n")).alias("p"), F.col("prior").alias("m"), parent
    )
    spread = seen.agg(
        F.sum("n").cast("double").alias("total"), F.count(F.lit(1)).alias("groups"),
        F.count_distinct(parent).alias("parents"),
        F.sum(F.expr("n * (p - m) * (p - m)")).alias("between"),
        F.sum(F.expr("n * p * (1 - p)")).alias("within"),
        F.sum(F.expr("CAST(n AS DOUBLE) * n")).alias("squares"),
    ).selectExpr(
        "groups - parents AS free", "total - groups AS rest", "between", "within",
        "total - squares / total AS width",
    ).selectExpr(
        "try_divide(between, free) AS msb", "coalesce(try_divide(within, rest), 0) AS msw",
        "try_divide(width, free) AS n0",
    ).selectExpr("try_divide(msb - msw, msb + (n0 - 1) * msw) AS rho").selectExpr(
        f"CASE WHEN rho IS NULL OR rho <= 0 THEN {STRONGEST} WHEN rho >= 1 THEN {WEAKEST} "
        f"ELSE least(greatest((1 - rho) / rho, {WEAKEST}), {STRONGEST}) END AS weight"
    )
    # The spread is one row by construction.
    return counts.join(F.broadcast(spread)).withColumn(
        "rate", F.expr("(b + weight * prior) / (n + weight)")
    )


def host_reputation(pages: DataFrame, outcomes: DataFrame, z=Z, key="page_id") -> DataFrame:
    """Posterior of the bad rate per host: ``host, pages, bad, rate, bound``.

    ``pages`` has (``key``, host); ``outcomes`` has (``key``, bad) with 0 or 1, more than one
    row a key allowed, nulls left out. Every page with the key has the outcome, whatever its
    host. A host without outcomes has its domain's rate.
    """
    known = outcomes.filter("bad IS NOT NULL").groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("bad").alias("_b")
    )
    # Pages of a host that show the same are counted first, so that no key is hot in the join.
    shown = pages.groupBy("host", key).agg(F.count(F.lit(1)).alias("_pages"))
    hosts = (
        shown.join(known, key, "left").groupBy("host").agg(
            F.coalesce(F.sum(F.expr("_pages * _n")), F.lit(0)).alias("n"),
            F.coalesce(F.sum(F.expr("_pages * _b")), F.lit(0)).alias("b"),
        )
    )
    domain, suffix = host_levels(F.col("host"))
    hosts = hosts.withColumn("domain", domain).withColumn("suffix", suffix)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    whole = suffixes.agg(((F.sum("b") + 1) / (F.sum("n") + 2)).alias("prior"))
    top = suffixes.join(F.broadcast(whole)).withColumn("everything", F.lit(1))
    by_suffix = _rates(top, "suffix", "everything").select("suffix", F.col("rate").alias("prior"))
    by_domain = _rates(domains.join(by_suffix, "suffix"), "domain", "suffix").select(
        "domain", F.col("rate").alias("prior")
    )
    by_host = _rates(hosts.join(by_domain, "domain"), "host", "domain")
    a, b = "(b + weight * prior)", "(n - b + weight * (1 - prior))"
    deviation = f"sqrt({a} * {b} / (({a} + {b}) * ({a} + {b}) * ({a} + {b} + 1)))"
    return by_host.select(
        "host", F.col("n").alias("pages"), F.col("b").alias("bad"), "rate",
        F.expr(f"rate - {z} * {deviation}").alias("bound"),
    )


def judge_urls(pages: DataFrame, outcomes: DataFrame, limit=LIMIT, rules=RULES,
               key="page_id") -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``.

    ``outcomes`` has (``key``, bad), the key being ``page_id``, or ``doc_id`` for the document
    that the path of a page names.

    A null url, or one without ``://``, has an empty host and path and is judged as host ''.
    Repeated rows are all returned, each with the same verdict. A null key has no
    outcome. A very long url is one string like any other. An empty table gives no rows; without outcomes nothing is blocked but by rule.
    Other columns of ``pages``, the html among them, are not read.
    """
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = split.withColumn("doc_id", document_of(F.col("path"))) if key == "doc_id" else split
    bad = host_reputation(seen, outcomes, key=key).filter(F.col("bound") > limit).select(
        "host", F.lit("block").alias("_host_verdict")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.join(bad, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.col("_host_verdict"), F.lit("allow")).alias("verdict"),
    )
