"""URL filters: rules, and a tree of path templates that is learned per host.

Urls are counted by host and path first, so that the tree grows with the distinct
urls and a hot host is pre-aggregated. Level by level below a host:

* a segment with a digit is a wildcard, and so are all segments of a place where most
  of them are different;
* branches whose share of bad labels does not differ from that of their place, beyond
  chance, are merged; branches without labels show nothing and stay apart;
* what is left is the next level's template.

Levels go on until no place with several urls has a segment left; a url that is alone in
its place keeps its other segments, as its levels would. A template is rejected if the smoothed share of bad labels is high enough.
All steps are aggregates and joins of DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import settle

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A place is variable if it has so many different segments and they are at least every second of its labelled urls.
FAN = 10
#: Squared standard errors within which branches are similar.
SIMILAR = 4.0
#: Smoothed share of bad labels from which a template is rejected.
PURITY = 0.6
WILD, MERGED, NONE = "*", "~", ""


@dataclass(frozen=True)
class Rule:
    """Fits a host and all its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parts(url: str) -> tuple[Column, Column]:
    """Host and path: empty without ``://`` or without url."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), UPPER, UPPER.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The name of the longest rule that fits, or null. A list of rules is part of the expression."""
    if len(rules) > 1000:
        raise ValueError("rules are an expression; join a table of thousands of them instead")
    fits = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda rule: (len(rule.name), rule.name)):
        at_host = (host == rule.host) | host.endswith("." + rule.host)
        fits = F.when(at_host & path.startswith(rule.path), rule.name).otherwise(fits)
    return fits


def _level(urls: DataFrame, level: int) -> DataFrame:
    """``urls`` (host, path, at: template so far, rest: segments, n, labelled, bad) with one more segment in ``at``,
    and ``goes_on``: others are in the same place, and a segment is left there."""
    segment = F.coalesce(F.try_element_at("rest", F.lit(level)), F.lit(NONE))
    urls = urls.withColumn("segment", F.when(segment.rlike("[0-9]"), WILD).otherwise(segment))
    place = ["host", "at"]
    sums = [F.sum(c).alias(c) for c in ("n", "labelled", "bad")]
    branches = settle(
        urls.groupBy(*place, "segment").agg(*sums, F.count("*").alias("paths"), F.max(F.size("rest")).alias("deepest"))
    )
    places = branches.groupBy(*place).agg(F.count("*").alias("fan"), F.sum("n").alias("urls"))
    places = places.select(*place, (F.col("fan") >= FAN) & (2 * F.col("fan") >= F.col("urls")))
    places = places.toDF(*place, "variable")
    name = F.when(F.col("variable") & (F.col("segment") != NONE), WILD).otherwise(F.col("segment"))
    named = branches.join(places, place).withColumn("name", name)
    # what a wildcard takes together is one branch
    grown = F.sum("paths").alias("paths"), F.max("deepest").alias("deepest")
    whole = named.groupBy(*place, "name").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), *grown)
    of_place = whole.groupBy(*place).agg(F.sum("labelled").alias("all"), F.sum("bad").alias("all_bad"))
    share = F.col("all_bad") / F.col("all")
    # (bad - labelled * share)^2 <= SIMILAR * labelled * share * (1 - share), in whole numbers
    off = F.col("bad") * F.col("all") - F.col("labelled") * F.col("all_bad")
    spread = SIMILAR * F.col("labelled") * F.col("all_bad") * (F.col("all") - F.col("all_bad"))
    similar = (F.col("labelled") > 0) & (off.cast("double") * off <= spread.cast("double")) & share.isNotNull()
    to = F.when(similar & (F.col("name") != NONE), MERGED).otherwise(F.col("name"))
    merged = settle(whole.join(of_place, place).select(*place, "name", to.alias("to"), "paths", "deepest"))
    next_places = merged.groupBy(*place, "to").agg(*grown)
    next_places = next_places.select(*place, "to", ((F.col("paths") > 1) & (F.col("deepest") > level)).alias("goes_on"))
    merged = merged.select(*place, "name", "to").join(next_places, [*place, "to"])
    to = named.select(*place, "segment", "name").join(merged, [*place, "name"]).select(*place, "segment", "to", "goes_on")
    joined = urls.drop("goes_on").join(to, [*place, "segment"])
    at = F.when(F.col("to") == NONE, F.col("at")).otherwise(F.concat("at", F.lit("/"), F.col("to")))
    return settle(joined.withColumn("at", at).drop("segment", "to"))


def _alone(level: int) -> Column:
    """``at`` with the segments behind ``level``, as further levels would add them for a url that is alone."""
    left = F.slice("rest", F.lit(level + 1), F.greatest(F.size("rest") - level, F.lit(0)))
    names = F.transform(left, lambda x: F.when(F.col("labelled") > 0, MERGED).when(x.rlike("[0-9]"), WILD).otherwise(x))
    return F.concat_ws("/", "at", names)


def templates(urls: DataFrame) -> DataFrame:
    """host, path, label (1 bad, 0 good, null) to host, path, template, labelled, bad of the template, rejected."""
    counted = urls.groupBy("host", "path").agg(
        F.count("*").alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("bad")
    )
    segments = F.filter(F.split("path", "/"), lambda x: x != "")
    going = settle(counted.withColumns({"rest": segments, "at": F.lit("")}))
    ready, level = [], 0
    while level == 0 or not going.isEmpty():
        level += 1
        urls = _level(going, level)
        # a place that ends here has one url, or none with segments left
        ready.append(urls.where("not goes_on").select("host", "path", _alone(level).alias("at"), "labelled", "bad"))
        going = urls.where("goes_on")
    tree = reduce(DataFrame.unionByName, ready)
    sums = tree.groupBy("host", "at").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    rejected = (F.col("bad") + 1) / (F.col("labelled") + 2) >= PURITY
    return tree.select("host", "path", "at").join(sums.withColumn("rejected", rejected), ["host", "at"]).withColumnRenamed("at", "template")


def judge(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, template.

    The verdict is that of the longest rule that fits. The rules' verdicts are also the
    labels from which the template tree learns; where no rule fits, its rejection is the
    verdict. A null url, or one without ``://``, has an empty host and path, which is
    judged like any other. Repeated rows stay repeated; other columns are not read.
    """
    host, path = parts(f"`{url_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = [rule.name for rule in rules if rule.verdict == "block"]
    bad = F.when(F.col("rule").isNotNull(), F.col("rule").isin(blocked).cast("int")) if rules else F.lit(None).cast("int")
    tree = templates(rows.select("host", "path", bad.alias("label")))
    known = rows.join(tree.select("host", "path", "template", "rejected"), ["host", "path"], "left")
    blocked_by = F.when(F.col("rule").isNotNull(), bad == 1).otherwise(F.col("rejected"))
    verdict = F.when(blocked_by, "block").otherwise("allow")
    return known.select(F.col("id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "template")
