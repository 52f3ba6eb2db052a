"""URL filters: host-suffix and path-prefix expressions, joined with the rules on short hash prefixes, then confirmed.

Each URL stands for expressions like those of a browser's block lists: every suffix of its host on label boundaries, times
every prefix of its path that ends in a slash. They meet the rules by an equi-join on the first 32 bits of a
digest; the whole digest and the path confirm a match; the longest rule wins. Hosts and paths are expanded no deeper than
the deepest rule (two numbers from the rules), which loses nothing, so an odd URL cannot blow up. The keyed
rules are a written table, so Catalyst knows its size when it plans: where it is small it is broadcast and no page moves; else adaptive
execution splits hot keys.

Rules (host, path, verdict). A rule fits its host and all subdomains, if the URL's path starts with the rule's; of the
fitting rules the one with the longest host wins, then the longest path, then `block` before `allow`. A URL without a
fitting rule gets the default verdict.

Defined results: a null URL, or one without `://`, has an empty host and path, and the default verdict; repeated rows are
judged each; a rule with a null host or path fits nothing; rules given twice count once; an empty table gives no rows; without rules
everything gets the default; other columns are not read. A path that a rule's does not end with a slash is matched as a plain prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.storage import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, path), 256)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def keyed(rules: DataFrame) -> DataFrame:
    """The rules under the digest of their host and of their path up to its last slash."""
    rules = rules.select(F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    rules = rules.filter("rule_host is not null and rule_path is not null and rule_verdict is not null").distinct()
    base = F.regexp_extract("rule_path", r"(?s)^(.*/)?", 0)
    digest = _digest(F.col("rule_host"), base)
    return rules.select("*", _prefix(digest).alias("prefix"), digest.alias("rule_digest"), F.size(F.split("rule_host", r"\.", -1)).alias("labels"), _slashes(base).alias("slashes"))


def expressions(host: Column, path: Column, labels: Column, slashes: Column) -> Column:
    """Host suffixes of at most so many labels, times path prefixes of at most so many slashes, each as a digest."""
    names = F.split(host, r"\.", -1)
    n = F.least(F.size(names), labels)
    hosts = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(names, F.size(names) - i + 1, i), "."))
    parts = F.split(path, "/", -1)
    m = F.least(F.size(parts) - 1, slashes)
    paths = F.transform(F.sequence(F.lit(0), m), lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(parts, F.lit(1), i), "/"), F.lit("/"))))
    return F.flatten(F.transform(hosts, lambda h: F.transform(paths, lambda p: _digest(h, p))))


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """pages (page_id, url), rules (host, path, verdict) -> page_id, host, path, rule, verdict."""
    rules = stored(keyed(rules), "rules")
    deepest = rules.agg(F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("slashes"), F.lit(0))).first()
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.monotonically_increasing_id().alias("place"))
    if not deepest[0]:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    some = expressions(F.col("host"), F.col("path"), F.lit(deepest[0]), F.lit(deepest[1]))
    spread = urls.withColumn("digest", F.explode(some))
    spread = spread.withColumn("prefix", _prefix(F.col("digest")))
    fits = (spread["prefix"] == rules["prefix"]) & (spread["digest"] == rules["rule_digest"]) & F.startswith(spread["path"], rules["rule_path"]) & (spread["host"] != "")
    found = spread.join(rules, fits, "left")
    order = F.struct(
        F.length("rule_host").alias("a"),
        F.length("rule_path").alias("b"),
        (F.col("rule_verdict") == "block").alias("c"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = found.groupBy("place", "page_id", "host", "path").agg(F.max(F.when(F.col("rule_host").isNotNull(), order)).alias("best"))
    return best.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
