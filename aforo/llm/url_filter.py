"""URL filters by hash prefixes.

A URL is expanded into host suffixes joined with path prefixes, of the shapes that the rules have. Expressions and rules
meet in an equi-join on a short prefix of their SHA-256; full digests confirm a match, and the longest rule decides.
Each distinct pair of host and path is expanded and judged once, however many rows hold it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.llm.common import Staging
from aforo.operators.joins import lookup_join

PREFIX_BYTES = 4
LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MARK = "://"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without it."""
    return F.translate(F.regexp_extract(_after(url), r"(?s)^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, MARK)
    return F.coalesce(F.when(at > 0, F.substring(url, at + len(MARK), F.length(url))), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("/"), path), 256)


def _prefix(digest: Column) -> Column:
    return F.substring(digest, 1, 2 * PREFIX_BYTES)


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (action, rule) with their parts and digests, one row per rule; block wins over allow for the same rule."""
    at = F.instr("rule", "/")
    parts = rules.where("rule IS NOT NULL AND instr(rule, '/') > 0").select(
        "rule",
        F.lower("action").alias("action"),
        F.translate(F.substring("rule", F.lit(1), at - 1), UPPER, LOWER).alias("rule_host"),
        F.substring("rule", at, F.length("rule")).alias("rule_path"),
    )
    one = parts.groupBy("rule_host", "rule_path").agg(F.max("action").alias("action"), F.min("rule").alias("rule"))
    digest = _digest(F.col("rule_host"), F.col("rule_path"))
    return one.withColumn("digest", digest).withColumn("prefix", _prefix(F.col("digest")))


def _expressions(shapes: list[tuple[int, int]]) -> Column:
    """The (host suffix, path prefix) pairs of each shape (labels of the host, characters of the path) that fits."""
    host, path = F.col("host"), F.col("path")
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    made = [
        F.when(
            (labels >= n) & (F.length(path) >= length),
            F.struct(F.substring_index(host, ".", -n).alias("host"), F.substring(path, 1, length).alias("path")),
        )
        for n, length in shapes
    ]
    return F.filter(F.array(*made), lambda e: e.isNotNull())


def filter_urls(
    df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", small: bool | None = None
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (NULL if none fits) and ``verdict`` (``default`` if none fits).

    ``rules`` has ``action`` (allow, block) and ``rule`` (host and path as one string, like ``org/``). A rule
    fits its host and all subdomains if the path starts with the rule's; the longest rule wins, then the one
    with the longer host. A NULL or malformed URL has an empty host and path and fits no rule. Rules
    without a slash are not rules. Columns of those names are replaced; equal rows get equal results.

    Only the shapes of the rules reach the driver: pairs of small numbers, however many rules there are. A rule
    table within the broadcast bound is broadcast, a larger one joined by shuffle (``small`` states it).
    """
    made = prepared(rules)
    shapes = sorted(
        (r.labels, r.length)
        for r in made.select(
            F.size(F.split("rule_host", r"\.")).alias("labels"), F.length("rule_path").alias("length")
        )
        .distinct()
        .collect()
    )
    kept = [c for c in df.columns if c not in ("host", "path", "rule", "verdict")]
    address = F.col(f"`{url}`")
    placed = df.select(*[F.col(f"`{c}`") for c in kept], host_of(address).alias("host"), path_of(address).alias("path"))
    if not shapes:
        return placed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    source = df.select(host_of(address).alias("host"), path_of(address).alias("path")).distinct()
    expressions = source.select("host", "path", F.explode(_expressions(shapes)).alias("e"))
    expressions = expressions.withColumn("own", _digest(F.col("e.host"), F.col("e.path")))
    expressions = expressions.withColumn("own_prefix", _prefix(F.col("own")))
    hits = lookup_join(expressions, made, [("own_prefix", "prefix")], "inner", small).where("own = digest")
    best = hits.groupBy("host", "path").agg(
        F.max(
            F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("h"), "rule", "action")
        ).alias("best")
    )
    verdicts = Staging(df.sparkSession, "urls").table(
        best.select(
            F.col("host").alias("__host"), F.col("path").alias("__path"), "best.rule", F.col("best.action").alias("verdict")
        ),
        "verdicts",
    )
    out = lookup_join(placed, verdicts, [("host", "__host"), ("path", "__path")], "left")
    return out.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
