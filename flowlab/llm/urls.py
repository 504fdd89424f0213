"""URL filters: host-suffix and path-prefix expressions, joined to rules on short hash prefixes.

Every URL is expanded into the expressions under which a rule could name it. Only the first bytes of an expression's
SHA-256 meet the rules; full digests confirm the few that meet, and the longest confirmed rule decides. All of it is
DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import others, shelved, stage
from flowlab.llm.skew import join_weighted

#: Hexadecimal digits of a digest that the join compares first (32 bits).
PREFIX_DIGITS = 8
#: At most so many rules (about 100 bytes each) are broadcast; longer lists are joined by shuffle.
BROADCAST_RULES = 100_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ?, # or the end, with A-Z in lower case; else ''."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else ''."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def expressions(host: Column, path: Column, most_labels: int, path_lengths: list[int]) -> Column:
    """array<struct<host,path>>: every host suffix of whole labels with every path prefix of a length that rules have."""
    labels = F.split(host, r"\.", -1)
    most = F.least(F.size(labels), F.lit(most_labels))
    suffixes = F.transform(F.sequence(F.lit(1), most), lambda n: F.array_join(F.slice(labels, -n, n), "."))
    lengths = F.filter(F.array(*[F.lit(n) for n in path_lengths]).cast("array<int>"), lambda n: n <= F.length(path))
    prefixes = F.transform(lengths, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("host"), p.alias("path")))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """The columns of pages with host, path, rule (host and path of the deciding rule, or null) and verdict.

    rules: host, path, verdict. A rule fits its host and all subdomains if the URL's path starts with the rule's path.
    The longest rule wins; of equally long ones that with the longer host, then the greater text. Rules for the same
    host and path count once, the greatest verdict (block before allow) wins; rules with a null host or verdict are
    ignored and a null path fits every path. Without a fitting rule the verdict is `default`.

    Null URLs and those without :// have an empty host and path and get the default. Repeated rows each get a verdict
    (equal URLs are judged once). Columns of pages named like the four results are replaced. An empty table gives an
    empty result; very long URLs are expanded only at the lengths that rules have.
    """
    known = (
        rules.select(F.col("host"), F.coalesce("path", F.lit("")).alias("path"), F.col("verdict"))
        .filter(F.col("host").isNotNull() & F.col("verdict").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    # Bounded: one number and the distinct path lengths of the rules (a URL has a few thousand characters).
    shape = known.agg(
        F.max(F.size(F.split("host", r"\.", -1))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
        F.count(F.lit(1)).alias("n"),
    ).first()
    own = ("host", "path", "rule", "verdict")
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    out = [*others(pages, own), host.alias("host"), path.alias("path")]
    if not shape["n"]:
        return pages.select(*out, F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))

    digest = F.sha2(F.concat("host", "path"), 256)
    keyed = known.select(
        F.substring(digest, 1, PREFIX_DIGITS).alias("r_short"),
        digest.alias("r_digest"),
        F.concat("host", "path").alias("r_rule"),
        F.length("host").alias("r_host"),
        F.col("verdict").alias("r_verdict"),
    )
    if shape["n"] <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)
    urls = pages.select(F.col(f"`{url}`").alias("u_url")).filter(F.col("u_url").isNotNull()).groupBy("u_url").agg(F.count(F.lit(1)).alias("u_rows"))
    expanded = (
        urls.select("u_url", "u_rows", F.explode(expressions(host_of(F.col("u_url")), path_of(F.col("u_url")), shape["labels"], shape["lengths"])).alias("e"))
        .select("u_url", "u_rows", F.sha2(F.concat("e.host", "e.path"), 256).alias("u_digest"))
        .withColumn("u_short", F.substring("u_digest", 1, PREFIX_DIGITS))
    )
    best = (
        expanded.join(keyed, F.col("u_short") == F.col("r_short"))
        .filter(F.col("u_digest") == F.col("r_digest"))
        .groupBy("u_url")
        .agg(F.min("u_rows").alias("u_rows"), F.max(F.struct(F.length("r_rule").alias("n"), F.col("r_host").alias("h"), F.col("r_rule").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("b"))
    )
    away, back = shelved(pages, own)
    base = pages.select(*away, host.alias("host"), path.alias("path"), F.col(f"`{url}`").alias("p_url"))
    # neither rows without a URL nor those of one very common URL are one task
    judged = join_weighted(base.filter(F.col("p_url").isNotNull()), stage(best, "judged-urls"), F.col("p_url") == F.col("u_url"), "u_rows", "left")
    result = judged.select(*back, "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
    return result.unionByName(base.filter(F.col("p_url").isNull()).select(*back, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")))
