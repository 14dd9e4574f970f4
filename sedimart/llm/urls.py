"""URL filters: host-suffix and path-prefix expressions, met by short hash prefixes, confirmed by full digests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of a digest that the join meets on.
PREFIX_DIGITS = 8
#: Rule tables up to so many rows are broadcast; larger ones are joined by a shuffle.
BROADCAST_RULES = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url, both empty if it is null or has no ``://``.

    The host goes from the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; the
    path goes on up to ``?``, ``#`` or the end.
    """
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws(" ", host, path), 256)


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, action) with digests, one row for each host and path.

    Rules with a null or empty host, a null action or a path that neither is empty nor begins with
    ``/`` fit nothing and go. Of a rule given both as allow and as block, block stays. A null path
    counts as empty.
    """
    host, path = F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))
    kept = rules.select(host.alias("host"), path.alias("path"), "action").filter(
        (F.col("host") != "") & F.col("action").isin("allow", "block") & ((F.col("path") == "") | F.col("path").startswith("/"))
    )
    one = kept.groupBy("host", "path").agg(F.max("action").alias("action"))
    digest = _digest(F.col("host"), F.col("path"))
    return one.select(
        F.concat("host", "path").alias("rule"),
        "action",
        F.size(F.split("host", r"\.")).alias("labels"),
        F.length("path").alias("path_length"),
        digest.alias("digest"),
        F.substring(digest, 1, PREFIX_DIGITS).alias("prefix"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row for each page: key, host, path, rule (the longest that fits, else null) and verdict.

    A rule (host, path, action) fits its host and all subdomains of it, if the url's path starts
    with the rule's. Every url is expanded into one expression for each shape of a rule, a shape
    being a number of host labels and a length of the path; there are at most as many as rules may
    be long, whatever the number of rules and urls. Expressions and rules meet on the first hex
    digits of a digest, and the whole digest confirms the match. The longest rule wins, by
    characters of host and path; of equally long ones the one that sorts last.

    A url without host fits no rule and gets ``default``, as does one that no rule fits. Repeated
    pages and null keys give a row each; no rules give the default for all. Only ``key`` and ``url``
    are read, so other columns, whatever their names, play no part.
    """
    table = rule_table(rules)
    shapes = [tuple(r) for r in table.select("labels", "path_length").distinct().orderBy("labels", "path_length").collect()]
    host, path = host_and_path(F.col(url))
    urls = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    if not shapes:
        return urls.select(F.col("key").alias(key), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    labels = F.size(F.split("host", r"\."))
    fitting = [
        F.when(
            (F.col("host") != "") & (labels >= n) & (F.length("path") >= length),
            _digest(F.substring_index("host", ".", -n), F.substring("path", 1, length)),
        )
        for n, length in shapes
    ]
    # the row number lives from here to the next grouping only, within one job
    numbered = urls.withColumn("row", F.monotonically_increasing_id())
    expressions = numbered.select("*", F.explode_outer(F.array_compact(F.array(*fitting))).alias("expression"))
    expressions = expressions.withColumn("prefix", F.substring("expression", 1, PREFIX_DIGITS))
    found = table.select("prefix", "digest", F.struct(F.length("rule").alias("n"), "rule", "action").alias("fit"))
    if table.count() <= BROADCAST_RULES:
        found = F.broadcast(found)
    met = expressions.join(found, "prefix", "left")
    best = F.max(F.when(F.col("digest") == F.col("expression"), F.col("fit")))
    same = [F.first(c).alias(c) for c in ("key", "host", "path")]
    judged = met.groupBy("row").agg(*same, best.alias("fit"))
    return judged.select(
        F.col("key").alias(key), "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.action", F.lit(default)).alias("verdict")
    )


def rules_frame(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A rule table from (action, host, path) tuples."""
    rows = [spark.range(1).select(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("action")) for a, h, p in rules]
    return reduce(DataFrame.unionByName, rows)
