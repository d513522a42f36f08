"""URL filters: fixed rules, and boosted trees on lexical features for the rest.

All of it is DataFrame expressions. The labelled URLs are those a rule decides; the trees
are fitted to a bounded sample of them and become one expression over the features, so a
page is judged where its URL is read.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.llm import boosting
from landfall.llm.common import written
from landfall.operators.joins import splittable

TRAIN_ROWS = 20_000     # distinct labelled URLs fitted on, those of the least hash
TREES, TREE_DEPTH = 24, 3


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules that the query applies.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, low).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, path).otherwise("")


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The rule that fits with the longest host and path, as a struct; null if none does."""
    out = F.lit(None).cast("struct<name:string,verdict:string>")
    # A longer rule is asked first; among equals the later one in the list gives way.
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = fits & F.startswith(path, F.lit(rule.path))
        found = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, found).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Shannon's entropy of the characters, in bits."""
    letters = F.split(text, "")
    size = F.length(text)
    return F.aggregate(
        F.array_distinct(letters), F.lit(0.0),
        lambda sum_, c: sum_ - F.when(c == "", 0.0).otherwise(
            (size - F.length(F.replace(text, c, F.lit("")))) / size
            * F.log2((size - F.length(F.replace(text, c, F.lit("")))) / size)))


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a URL, but for the suffix's own statistics."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    return {
        "url_length": F.length(F.coalesce(url, F.lit(""))).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "labels": F.size(F.split(host, r"\.")).cast("double"),
        "depth": (F.size(F.split(path, "/")) - 1).cast("double"),
        "digit_share": _share(F.coalesce(url, F.lit("")), "[^0-9]"),
        "host_digits": _share(host, "[^0-9]"),
        "hyphens": F.length(F.regexp_replace(host, "[^-]", "")).cast("double"),
        "entropy": _entropy(host),
        "path_entropy": _entropy(path),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "[&;]")).cast("double")),
        "secure": F.startswith(F.lower(F.coalesce(url, F.lit(""))), F.lit("https")).cast("double"),
        "ending_length": F.length(F.substring_index(host, ".", -1)).cast("double"),
    }


class UrlModel(NamedTuple):
    trees: boosting.Trees
    names: list[str]
    share: float            # blocked of all labelled rows


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """Rows and blocked rows of each suffix, over all labelled rows."""
    return written(labelled.groupBy(suffix_of(F.col("host")).alias("suffix"))
                   .agg(F.count("*").alias("n"), F.sum(F.col("blocked").cast("long")).alias("bad")), "url-suffixes")


def _suffix_values(share: float) -> dict[str, Column]:
    """A suffix's statistics from its counts; null counts are those of one that no rule decides."""
    n, bad = (F.coalesce(name, F.lit(0)) for name in ("n", "bad"))
    # Smoothed by ten rows of the overall share, so that rare suffixes say little.
    return {"suffix_blocked": (bad + F.lit(10 * share)) / (n + 10), "suffix_count": F.log1p(n.cast("double"))}


def fit_urls(labelled: DataFrame, counts: DataFrame, train_rows: int = TRAIN_ROWS) -> UrlModel | None:
    """Fit to rows ``(url, host, path, blocked)``, at most ``train_rows`` distinct URLs of them."""
    total, blocked = counts.agg(F.sum("n"), F.sum("bad")).first()
    if not total or blocked in (0, total):
        return None
    values = features(F.col("url"), F.col("host"), F.col("path")) | _suffix_values(blocked / total)
    urls = labelled.groupBy("url", "host", "path", "blocked").agg(F.lit(1).alias("once"))

    def draw(rows: DataFrame, most: int) -> list:
        least = rows.orderBy(F.xxhash64("url"), "url").limit(most).withColumn("suffix", suffix_of(F.col("host")))
        return least.join(counts, "suffix", "left").select(
            F.xxhash64("url").alias("hash"), "url", F.col("blocked").cast("int").alias("blocked"),
            F.array(*values.values()).alias("x")).collect()

    sample = draw(urls, train_rows)
    if len(seen := {row.blocked for row in sample}) < 2:     # the other verdict is too rare to be drawn
        rare = draw(urls.where(F.col("blocked") != bool(seen.pop())), max(1, train_rows // 10))
        sample = sorted(sample, key=lambda row: (row.hash, row.url))[:max(1, train_rows - len(rare))] + rare
    sample.sort(key=lambda row: (row.hash, row.url))
    rows, target = np.array([row.x for row in sample], float), np.array([row.blocked for row in sample], float)
    trees = boosting.fit(rows, target, monotone=np.zeros(rows.shape[1], int), trees=TREES, depth=TREE_DEPTH)
    return UrlModel(trees, list(values), blocked / total)


def tree_score(trees: boosting.Trees, columns: Sequence[Column]) -> Column:
    """The trees as one expression: the log-odds of a row."""
    inner = trees.feature.shape[1]

    def walk(t: int, node: int) -> Column:
        if node >= inner:
            return F.lit(float(trees.value[t, node - inner]))
        if np.isinf(trees.threshold[t, node]):
            return walk(t, 2 * node + 1)
        left = columns[trees.feature[t, node]] <= F.lit(float(trees.threshold[t, node]))
        return F.when(left, walk(t, 2 * node + 1)).otherwise(walk(t, 2 * node + 2))

    out = F.lit(trees.base)
    for t in range(len(trees.value)):
        out = out + walk(t, 0)
    return out


def url_filter(df: DataFrame, id_col: str = "page_id", url_col: str = "url", *,
               rules: Sequence[Rule] = RULES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Allow or block each URL: the longest rule that fits decides, else the trees do.

    Returns one row per row of ``df``: the id, ``host``, ``path``, ``rule`` (host and path of
    the rule, else null), ``verdict`` and ``score`` (the trees' chance of ``block``; null if there
    is nothing to learn from, and then what no rule decides is allowed). A null URL and one without ``://``
    has an empty host and path, fits no rule and is judged by its features. Repeated URLs are
    judged alike, count once in the sample and each in the statistics of their host's suffix, which cover
    all rows that a rule decides; an empty table gives no rows.
    """
    told = df.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("url"))
    told = told.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    told = told.withColumn("found", rule_of(rules, F.col("host"), F.col("path")))
    labelled = told.where("found is not null").select(
        "url", "host", "path", (F.col("found.verdict") == "block").alias("blocked"))
    counts = suffix_counts(labelled)
    model = fit_urls(labelled, counts, train_rows)
    if model is None:
        chance = F.lit(None).cast("double")
        scored = told
    else:
        values = features(F.col("url"), F.col("host"), F.col("path")) | _suffix_values(model.share)
        # A suffix may hold most rows: both sides are shuffled plainly, so Spark can split it.
        met = told.withColumn("suffix", suffix_of(F.col("host"))).join(
            splittable(counts, ["suffix"]), "suffix", "left")
        scored = met.withColumns({f"x_{k}": v for k, v in values.items()})
        margin = tree_score(model.trees, [F.col(f"x_{k}") for k in model.names])
        chance = 1 / (1 + F.exp(-margin))
    judged = F.when(F.coalesce(F.col("score"), F.lit(0.0)) >= 0.5, "block").otherwise("allow")
    return (scored.withColumn("score", chance)
            .select(F.col("_id").alias(id_col), "host", "path", F.col("found.name").alias("rule"),
                    F.coalesce("found.verdict", judged).alias("verdict"), "score"))
