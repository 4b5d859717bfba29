"""URL filters: block and allow rules, and gradient-boosted trees on lexical features for the rest.

Rules: (action, host, path).  A rule fits its host and all subdomains if the URL's path starts
with the rule's path; the longest rule wins.

Trees: URLs that a rule fits are the labelled URLs (block 1, allow 0).  Features: lengths of URL, host and
path, depth, host labels, digit ratio, character entropy, parameter count, hyphens, and suffix statistics: the
smoothed share of blocked among the labelled URLs of the same last host label and of the same last two labels.
Statistics are counted in ``FOLDS`` folds of hosts: a labelled URL sees all folds but its own, so neither its
own label nor one of its host is among its features; any other URL sees all of them.  Trees of ``depth`` levels
on quantile bins are boosted in numpy on logistic loss with at most ``fit_rows`` labelled URLs, drawn by a hash.

``held_out`` judges the labelled URLs of one fold of hosts with trees and statistics of the other folds.

A null URL or one without ``://`` has an empty host and path and is judged by the trees from its other
features.  With no labelled URL, or labels of one kind, every other URL gets that share (none: allow).
Repeated rows keep their rows.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written

FEATURES = ("length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters", "hyphens",
            "suffix_blocked", "domain_blocked")
FOLDS = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The rule that decides (struct of rule string and action); null if none fits."""
    out = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(out)
    return out


def lexical(url: str | None, host: str, path: str) -> tuple[float, ...]:
    """The features of one URL that need no statistics."""
    url = url or ""
    n = len(url)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(url).values()) if n else 0.0
    query = url.partition("#")[0].partition("?")[2]
    return (n, len(host), len(path), path.count("/"), host.count(".") + 1 if host else 0, sum(c.isdigit() for c in url) / n if n else 0.0,
            entropy, sum(1 for p in query.split("&") if p), host.count("-") + path.count("-"))


class Trees:
    """Gradient-boosted trees: each level splits all nodes; leaves hold log-odds."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.bins, self.l2 = rounds, depth, rate, bins, l2
        self.prior, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.0
        self.prior = float(np.log(share / (1 - share))) if len(y) else -1.0
        if len(y) == 0 or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
        score = np.full(len(y), self.prior)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = p - y, p * (1 - p)
            node, tree = np.zeros(len(y), np.int64), []
            for level in range(self.depth):
                width = 1 << level
                best = (np.zeros(width), np.zeros(width, np.int64), np.full(width, np.inf))  # gain, feature, cut
                for f, c in enumerate(cuts):
                    if not len(c):
                        continue
                    k = len(c) + 1
                    cell = node * k + binned[:, f]
                    gl, hl = (np.bincount(cell, v, width * k).reshape(width, k) for v in (g, h))
                    gt, ht = gl.sum(1, keepdims=True), hl.sum(1, keepdims=True)
                    gl, hl = gl.cumsum(1)[:, :-1], hl.cumsum(1)[:, :-1]
                    gain = gl ** 2 / (hl + self.l2) + (gt - gl) ** 2 / (ht - hl + self.l2) - gt ** 2 / (ht + self.l2)
                    at = gain.argmax(1)
                    better = gain[np.arange(width), at] > best[0] + 1e-9
                    best[0][better], best[1][better], best[2][better] = gain[np.arange(width), at][better], f, c[at][better]
                tree.append((best[1], best[2]))
                node = node * 2 + (x[np.arange(len(y)), best[1][node]] > best[2][node])
            leaves = 1 << self.depth
            value = -self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.l2)
            self.trees.append((tree, value))
            score += value[node]
        return self

    def blocked(self, x: np.ndarray) -> np.ndarray:
        """Probability of block."""
        score = np.full(len(x), self.prior)
        for tree, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for feature, cut in tree:
                node = node * 2 + (x[np.arange(len(x)), feature[node]] > cut[node])
            score += value[node]
        return 1 / (1 + np.exp(-score))


def suffixes(df: DataFrame) -> DataFrame:
    return df.withColumn("suffix", F.substring_index("host", ".", -1)).withColumn("domain", F.substring_index("host", ".", -2))


def fold(host: Column) -> Column:
    return F.pmod(F.xxhash64(host, F.lit("url-fold")), F.lit(FOLDS)).cast("int")


def with_statistics(urls: DataFrame, smooth: float = 5.0) -> DataFrame:
    """``urls`` (with host and label, null if unlabelled) plus the suffix statistics.  The counts come from all
    labelled URLs; each is a table with one row per suffix and an array of folds, joined back by the suffix."""
    urls = suffixes(urls).withColumn("fold", fold(F.col("host")))
    for key, name in (("suffix", "suffix_blocked"), ("domain", "domain_blocked")):
        def by_fold(value: Column) -> Column:
            return F.array(*[F.sum(F.when(F.col("fold") == i, value).otherwise(0.0)) for i in range(FOLDS)])

        counts = written(urls.where("label is not null").groupBy(F.col(key).alias("k")).agg(
            by_fold(F.lit(1.0)).alias("n"), by_fold(F.col("label")).alias("blocked")), "url-suffixes")
        urls = urls.join(counts, F.col(key) == F.col("k"), "left")

        def seen(column: str) -> Column:
            whole = F.aggregate(column, F.lit(0.0), lambda a, x: a + x)
            return F.coalesce(F.when(F.col("label").isNull(), whole).otherwise(whole - F.col(column)[F.col("fold")]), F.lit(0.0))

        urls = urls.withColumn(name, (seen("blocked") + smooth / 2) / (seen("n") + smooth)).drop("k", "n", "blocked")
    return urls


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], id_col: str = "page_id", url_col: str = "url",
          fit_rows: int = 20_000, block_at: float = 0.5, hidden_fold: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, blocked): one row for each row of ``pages``; ``blocked``: the trees'
    probability of block, also where a rule decides.  Labels of hosts in ``hidden_fold`` are not learnt from."""
    url = F.col(url_col).cast("string")
    host, path = parts(F.coalesce(url, F.lit("")))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("fit", ruled(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("label", F.when(F.col("fit.action") == "block", 1.0).when(F.col("fit.action") == "allow", 0.0))
    if hidden_fold is not None:
        rows = rows.withColumn("label", F.when(fold(F.col("host")) != hidden_fold, F.col("label")))
    rows = with_statistics(rows).select("page_id", "url", "host", "path", F.col("fit.rule").alias("rule"), "fit.action", "label",
                                        "suffix_blocked", "domain_blocked")

    def features(part: pa.RecordBatch) -> np.ndarray:
        cols = [part.column(c).to_pylist() for c in ("url", "host", "path", "suffix_blocked", "domain_blocked")]
        return np.array([(*lexical(u, h, p), s, d) for u, h, p, s, d in zip(*cols)], float).reshape(-1, len(FEATURES))

    labelled = rows.where("label is not null")
    n = labelled.count()
    parts_ = 1 << 20
    drawn = labelled.where(F.pmod(F.xxhash64("url", "page_id"), F.lit(parts_)) < min(parts_, parts_ * fit_rows // max(1, n) + 1))
    few = drawn.limit(2 * fit_rows).toArrow()
    x = [features(b) for b in few.to_batches()]
    model = Trees().fit(np.concatenate(x) if x else np.empty((0, len(FEATURES))), few.column("label").to_numpy())
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            p = shared.value.blocked(features(batch))
            own = pa.array(np.where(p >= block_at, "block", "allow").tolist(), pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("page_id", "host", "path", "rule")],
                                              pc.coalesce(batch.column("action"), own), pa.array(p)],
                                             ["page_id", "host", "path", "rule", "verdict", "blocked"])

    return rows.mapInArrow(run, "page_id long, host string, path string, rule string, verdict string, blocked double")


def held_out(pages: DataFrame, rules: list[tuple[str, str, str]], hidden_fold: int = 0, block_at: float = 0.5, **options) -> DataFrame:
    """(suffix, n, blocked, right): URLs of the hidden fold's hosts that a rule labels, by last host label: their
    number, how many the rules block, and how many the trees, which saw none of these hosts, judge alike."""
    rows = judge(pages, rules, block_at=block_at, hidden_fold=hidden_fold, **options)
    block = F.col("verdict") == "block"
    return (suffixes(rows.where(F.col("rule").isNotNull() & (fold(F.col("host")) == hidden_fold))).groupBy("suffix").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(block).alias("blocked"), F.count_if(block == (F.col("blocked") >= block_at)).alias("right")))
