"""URL filter: expressions of host suffixes and path prefixes against a rule list.

Every URL is expanded into the (host suffix, path prefix) expressions that
could name a rule. Expressions meet rules in an equality join on a short hash
prefix; the full digest confirms a match and the longest rule wins. URLs are
expanded once per distinct (host, path), so a very common address is looked
up once, and only suffix and prefix lengths that occur in the rules are made.

Defined results: a null url or one without ``://`` has an empty host and path
and fits no rule; a host or path shorter than every rule fits none; repeated
rows each get their verdict; of two rules with the same host and path ``block``
wins; an empty rule list gives the default verdict; an empty table an empty
result. Other columns of the input are returned as they are, unless they are
named like a result column, which then replaces them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revenue_engine.llm.common import ascii_lower

SHORT_HEX = 8  # hash prefix of the join: 32 bits


def url_host(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict.

    ``rules``: (host, path, verdict) with verdict ``block`` or ``allow``; a
    rule fits its host and every subdomain of it where the path starts with
    the rule's path.
    """
    listed = (rules.where("host is not null and path is not null")
              .groupBy(ascii_lower(F.col("host")).alias("rhost"), F.col("path").alias("rpath"))
              .agg(F.max(F.col("verdict") == "block").alias("blocked"))
              .withColumn("rule", F.concat("rhost", "rpath"))
              .withColumn("digest", F.sha2(F.concat_ws("\n", "rhost", "rpath"), 256))
              .withColumn("short", F.substring("digest", 1, SHORT_HEX)))
    # Distinct (host length, path length) pairs: bounded by URL lengths, not by the rule count.
    lengths = [(r[0], r[1]) for r in listed.select(F.length("rhost"), F.length("rpath")).distinct().collect()]

    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")])
    urls = pages.select(row.alias("_row"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    if not lengths:
        return urls.select("_row.*", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    keys = urls.select("host", "path").distinct()
    exprs = keys.withColumn("e", F.explode(F.filter(F.array(*[_expression(h, p) for h, p in lengths]),
                                                    lambda e: e.isNotNull())))
    exprs = (exprs.withColumn("edigest", F.sha2("e", 256))
             .withColumn("eshort", F.substring("edigest", 1, SHORT_HEX)))
    found = (exprs.join(listed, F.col("eshort") == F.col("short"))
             .where(F.col("edigest") == F.col("digest"))
             .groupBy("host", "path")
             .agg(F.max(F.struct(F.length("rule").alias("n"), F.length("rhost").alias("h"),
                                 F.col("blocked"), F.col("rule"))).alias("best")))
    return (urls.join(found, ["host", "path"], "left")
            .select("_row.*", "host", "path", F.col("best.rule").alias("rule"),
                    F.when(F.col("best.blocked"), "block").when(~F.col("best.blocked"), "allow")
                    .otherwise(default).alias("verdict")))


def _expression(hlen: int, plen: int) -> Column:
    """The expression with a host suffix of ``hlen`` and a path prefix of ``plen`` characters, else null."""
    n = F.length("host")
    edge = (n == hlen) | (F.substring(F.col("host"), n - F.lit(hlen), F.lit(1)) == ".")
    fits = (n >= hlen) & (F.length("path") >= plen) & edge
    suffix = F.substring(F.col("host"), n - F.lit(hlen - 1), F.lit(hlen))
    return F.when(fits, F.concat_ws("\n", suffix, F.substring("path", 1, plen)))
