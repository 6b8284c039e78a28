"""URL filter by host-suffix and path-prefix expressions (DataFrame functions
only).

Every URL is expanded into (host suffix, path prefix) expressions; an
expression meets a rule by an equi-join on a short prefix of its SHA-256
digest, the full digests confirm the meeting, and the longest confirmed rule
gives the verdict.

* Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
  lower-cased.  Path: from there up to ``?``, ``#`` or the end.  A null URL or
  one without ``://`` has an empty host and an empty path, and no rule fits.
* A rule fits its host and all subdomains, when the URL's path starts with the
  rule's path (character for character).  The longest rule (host and path
  together) wins; of two equally long ones the one with the longer host, then
  ``block``.  URLs without a fitting rule get ``default`` (allow).
* Empty host suffixes (``a..b``, a final dot) are ordinary expressions.
* Repeated rows are kept as often as they come; a null page_id is kept.  Rules
  with a null host, path or action are ignored; a repeated rule counts once,
  a rule with both actions blocks.

Pages are first counted per (page_id, url), so that copies are expanded once.
The rules meet the expressions through the planner's join: a small rule table
is broadcast by its known size, a large one is shuffled with a salt
(``salts``) on the expression side so that a digest prefix that a third of
all URLs share (``net/``) is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8  # digits of the digest that the join key holds (4 bytes)


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL column."""
    given = F.instr(url, "://") > 0
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(given, lower).otherwise(""), F.when(given, path).otherwise("")


def host_suffixes(host: Column) -> Column:
    """The host and every part of it after a dot."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_prefixes(path: Column, lengths: list[int]) -> Column:
    """Prefixes of the path that end in a slash, and those of the given
    lengths (the lengths of rule paths that end otherwise)."""
    n = F.length(path)
    slashes = F.filter(F.sequence(F.lit(0), n), lambda i: F.substr(path, i, F.lit(1)) == "/")
    ends = F.when(n > 0, slashes).otherwise(F.array().cast("array<int>"))
    if lengths:
        other = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda i: i <= n)
        ends = F.array_distinct(F.concat(ends, other))
    return F.transform(ends, lambda i: F.substr(path, F.lit(1), i))


def digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def apply_rules(pages: DataFrame, rules: DataFrame, default: str = "allow",
                salts: int = 1) -> DataFrame:
    """pages(page_id, url) and rules(host, path, action) ->
    (page_id, url, host, path, rule, verdict), one row per page row."""
    rules = (rules.select(F.lower("host").alias("r_host"), F.col("path").alias("r_path"),
                          F.lower("action").alias("action"))
             .dropna().groupBy("r_host", "r_path")
             .agg(F.max("action").alias("action"))  # block over allow
             .withColumn("rule", F.concat("r_host", "r_path"))
             .withColumn("r_digest", digest(F.concat_ws("\n", "r_host", "r_path")))
             .withColumn("key", F.substring("r_digest", 1, PREFIX_HEX))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))))
    # Lengths of rule paths without a final slash: at most as many as a path is long.
    lengths = [r[0] for r in rules.filter(~F.col("r_path").endswith("/"))
               .select(F.length("r_path")).distinct().collect()]
    host, path = split_url(F.col("url"))
    urls = (pages.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("valid", F.coalesce(F.instr("url", "://") > 0, F.lit(False)))
            .withColumn("host", host).withColumn("path", path))
    expressions = (
        urls.filter("valid")
        .withColumn("suffix", F.explode(host_suffixes(F.col("host"))))
        .withColumn("prefix", F.explode(path_prefixes(F.col("path"), lengths)))
        .select("page_id", "url",
                digest(F.concat_ws("\n", "suffix", "prefix")).alias("digest"),
                F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int").alias("salt"))
        .withColumn("key", F.substring("digest", 1, PREFIX_HEX)))
    hits = (expressions.join(rules, ["key", "salt"])
            .filter(F.col("digest") == F.col("r_digest"))
            .select("page_id", "url",
                    F.struct(F.length("rule").alias("a"), F.length("r_host").alias("b"),
                             F.col("action").alias("c"), F.col("rule").alias("rule")).alias("best"),
                    F.lit(0).cast("bigint").alias("n")))
    rows = (urls.select("page_id", "url", F.lit(None).cast(hits.schema["best"].dataType).alias("best"), "n")
            .unionByName(hits)
            .groupBy("page_id", "url").agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    host, path = split_url(F.col("url"))
    return (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
            .select("page_id", "url", host.alias("host"), path.alias("path"),
                    F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.c"), F.lit(default)).alias("verdict")))
