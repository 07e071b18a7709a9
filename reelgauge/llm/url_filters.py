"""Verdicts on URLs: given rules first, else rules mined from labelled URLs.

Spark's FP-growth mines combinations of URL tokens together with the label. A combination becomes a
rule if it is frequent and one label is likely enough given it; a rule that a shorter one makes
superfluous is pruned. A URL is matched by an inverted index: rules are found by their rarest token
and hold if the URL has all their tokens.

All of it is DataFrame code; the mining is Spark's own distributed FP-growth.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelgauge.llm.common import stored

# A mined rule holds for at least this share of the labelled URLs, and this often gives its label.
SUPPORT = 0.002
CONFIDENCE = 0.6
# How much surer than the share of its label among all labelled URLs a rule must be.
LIFT = 1.2
# Token sets that occur most often: that many are joined by broadcast.
HOT_SETS = 10_000
DEFAULT = "allow"

AFTER_SCHEME = r"^.*?://([^/?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    found = F.regexp_extract(url, "(?s)" + AFTER_SCHEME, 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(found, upper, lower), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)" + AFTER_SCHEME + "([^?#]*)", 2), F.lit(""))


def given_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that fits: its host or a subdomain, and its path's
    beginning. Null if none fits."""
    found = F.lit(None).cast("string")
    for name, start, _ in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.lit(name + start)).otherwise(found)
    return found


def given_verdict(rule: Column, rules: list[tuple[str, str, str]]) -> Column:
    found = F.lit(None).cast("string")
    for name, start, verdict in rules:
        found = F.when(rule == name + start, F.lit(verdict)).otherwise(found)
    return found


def tokens(host: Column, path: Column) -> Column:
    """The tokens of a URL, sorted and distinct: labels of the host, their words, and the words of
    the path with numbers written as ``#``."""
    labels = F.filter(F.split(host, r"\."), lambda t: t != "")
    top = F.transform(F.slice(labels, -1, 1), lambda t: F.concat(F.lit("top:"), t))
    names = F.transform(labels, lambda t: F.concat(F.lit("host:"), t))
    words = F.filter(F.split(F.regexp_replace(host, "[0-9]+", "#"), r"[.\-_]"), lambda t: t != "")
    words = F.transform(words, lambda t: F.concat(F.lit("word:"), t))
    steps = F.filter(F.split(F.regexp_replace(F.lower(path), "[0-9]+", "#"), "/"), lambda t: t != "")
    steps = F.transform(steps, lambda t: F.concat(F.lit("path:"), t))
    some = F.when(F.size(labels) > 0, top).otherwise(F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.concat(some, names, words, steps)))


def mine(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE,
) -> DataFrame:
    """Rules from ``labelled`` (``tokens``, ``label``): their tokens, label and how sure they are.

    Columns: ``needs`` (array), ``rarest`` (the token to find the rule by), ``label``,
    ``confidence``, ``support``. A rule must be ``CONFIDENCE`` sure, and ``LIFT`` times as sure as its
    label is frequent: where most labelled URLs are blocked, a token they all share says nothing.
    Rows with a null label or without tokens are left out; an empty table gives no rule.
    """
    spark = labelled.sparkSession
    marked = labelled.where(F.col("label").isNotNull() & (F.size("tokens") > 0)).select(
        F.array_append("tokens", F.concat(F.lit("label:"), F.col("label"))).alias("items")
    )
    empty = "needs array<string>, rarest string, label string, confidence double, support double"
    if not marked.limit(1).count():
        return spark.createDataFrame([], empty)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(marked)
    rules = stored(
        model.associationRules.where(F.col("consequent")[0].startswith("label:"))
        .where(~F.exists("antecedent", lambda t: t.startswith("label:")))
        .where(F.col("lift") >= LIFT)
        .select(
            F.array_sort("antecedent").alias("needs"),
            F.substring(F.col("consequent")[0], 7, 1 << 30).alias("label"), "confidence", "support",
        ),
        "url-rules",
    )
    # Superfluous: with one token less, the same label is at least as sure.
    shorter = rules.select(
        F.col("needs").alias("general"), "label", F.col("confidence").alias("surer")
    )
    weaker = (
        rules.withColumn("drop", F.explode("needs"))
        .withColumn("general", F.array_remove("needs", F.col("drop")))
        .join(shorter, ["general", "label"]).where("surer >= confidence")
        .select("needs", "label").distinct()
    )
    often = (
        model.freqItemsets.where(F.size("items") == 1)
        .select(F.col("items")[0].alias("token"), F.col("freq"))
    )
    kept = rules.join(weaker, ["needs", "label"], "left_anti")
    rarest = (
        kept.withColumn("token", F.explode("needs")).join(often, "token")
        .groupBy("needs", "label").agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    )
    return stored(
        kept.join(rarest, ["needs", "label"]).select(
            "needs", "rarest", "label", "confidence", "support"
        ),
        "url-rules",
    )


def matched(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens`` and the ``label`` of the surest rule that holds, for sets with such a rule."""
    surest = F.struct(
        F.col("confidence"), F.col("support"), F.size("needs").alias("n"),
        F.concat_ws(" ", "needs").alias("text"), F.col("label"),
    )
    return (
        token_sets.withColumn("rarest", F.explode("tokens")).join(rules, "rarest")
        .where(F.size(F.array_except("needs", "tokens")) == 0)
        .groupBy("tokens").agg(F.max(surest).alias("best")).select("tokens", "best.label")
    )


def judged(
    urls: DataFrame, rules: list[tuple[str, str, str]], labelled: DataFrame | None = None,
    url: str = "url",
) -> DataFrame:
    """``urls`` with ``host``, ``path``, ``rule`` (the given rule that fits) and ``verdict``.

    ``labelled`` holds ``url`` and ``label`` to mine from; without it the URLs that a given rule
    decides are the labelled ones, and what is mined carries their verdicts over to similar URLs.
    A URL that neither a given nor a mined rule fits gets ``allow``. Null URLs and URLs without
    ``://`` have an empty host and path; very long URLs are read whole; an empty table gives an empty table; repeated rows are
    judged each; input columns named like a result are replaced.
    """
    own = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    parts = urls.select(
        *own, host(F.col(url)).alias("host"), path(F.col(url)).alias("path")
    )
    ruled = parts.withColumn("rule", given_rule(F.col("host"), F.col("path"), rules))
    by_rule = given_verdict(F.col("rule"), rules)
    if labelled is None:
        known = ruled.where("rule is not null").select(
            tokens(F.col("host"), F.col("path")).alias("tokens"), by_rule.alias("label")
        )
    else:
        known = labelled.select(
            tokens(host(F.col("url")), path(F.col("url"))).alias("tokens"), "label"
        )
    mined = mine(known)
    # Rows that a given rule decides never meet the join.
    decided = ruled.where("rule is not null").withColumn("_label", F.lit(None).cast("string"))
    open_ = ruled.where("rule is null").withColumn("_tokens", tokens(F.col("host"), F.col("path")))
    found = with_labels(open_, mined).drop("_tokens")
    return decided.unionByName(found).select(
        *own, "host", "path", "rule",
        F.coalesce(by_rule, F.col("_label"), F.lit(DEFAULT)).alias("verdict"),
    )


def with_labels(rows: DataFrame, mined: DataFrame, hot_sets: int = HOT_SETS) -> DataFrame:
    """``rows``, which have ``_tokens``, with the ``_label`` of the surest mined rule, or null.

    It depends on the tokens alone: each distinct set is matched once. The most frequent sets are
    joined back by a broadcast of at most ``hot_sets`` rows, so the URLs of a host that holds a
    third of the pages stay in their tasks.
    """
    sets = stored(rows.groupBy(F.col("_tokens").alias("tokens")).agg(F.count("*").alias("n")), "url-sets")
    label = matched(sets.select("tokens"), mined)
    known = stored(
        sets.join(label, "tokens", "left")
        .select(F.col("tokens").alias("_tokens"), F.col("label").alias("_label"), "n"), "url-labels",
    )
    top = known.orderBy(F.desc("n"), "_tokens").limit(hot_sets)
    hot = F.broadcast(stored(top.select("_tokens", "_label"), "url-hot"))
    rest = rows.join(hot.select("_tokens"), "_tokens", "left_anti")
    others = known.select("_tokens", "_label")
    return rows.join(hot, "_tokens").unionByName(rest.join(others, "_tokens", "left"))
