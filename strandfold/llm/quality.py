"""Document quality by a classifier and what the document's site and path say.

A logistic model scores each document from figures of its text. Its scores, summed over
each host and each path, update the prior: a path's rate is drawn towards its host's and a host's
towards the corpus rate, the more the fewer documents it has. The strength of either
pull is estimated from how much hosts and paths vary (method of moments). The
document's evidence and its path's posterior add up as log odds.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandfold.llm.common import stored, text_key

#: Labelled documents that the classifier is fitted on: those with the smallest hashes of their ids.
SAMPLE = 20_000
#: Different texts of one such id that count: those with the smallest hashes.
TEXTS = 2
PENALTY = 1.0
ROUNDS = 30
#: Log odds that a document's own evidence is held to, so that a site can matter but not decide alone.
EVIDENCE = 12.0
FEATURES = ("log_words", "distinct", "repeats", "marks", "pipes", "capitals", "word_length", "ends", "digits", "doubled", "short")


def with_figures(rows: DataFrame) -> DataFrame:
    """Adds ``_x``, the figures of ``_text``, all between about 0 and a few units; a text without words has zeros.

    Words, and what is left of a text without its small letters, are columns that all figures share.
    """
    rows = rows.withColumns({
        "_words": F.filter(F.split("_text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""),
        "_rest": F.regexp_replace("_text", "[a-z\u00DF-\u00FF\\x20\\n,]+", ""),
    })
    chars = F.greatest(F.char_length("_text"), F.lit(1)).cast("double")
    n = F.greatest(F.size("_words"), F.lit(1)).cast("double")
    count = lambda which: (F.char_length("_rest") - F.char_length(F.translate("_rest", which, ""))).cast("double")
    following = F.slice("_words", F.lit(2), F.greatest(F.size("_words") - 1, F.lit(0)))
    pairs = F.size(F.filter(F.arrays_zip(F.col("_words").alias("w"), following.alias("v")), lambda p: p["w"] == p["v"])).cast("double")
    return rows.withColumn("_x", F.array(
        F.log1p(F.size("_words").cast("double")),
        F.size(F.array_distinct("_words")).cast("double") / n,
        pairs / n,
        count("!@#$%^&*~=<>{}[]") / n,
        count("|") / n,
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÀÇÑÍÓ") / chars * 4,
        F.char_length("_text").cast("double") / n / 10,
        count(".?") / n,
        count("0123456789") / n,
        count("!") / n,
        (F.size("_words") < 5).cast("double"),
    ))


def fit(rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the last is the intercept), centre and scale of a ridge logistic model, by Newton's method.

    One class alone, or no rows: a model that gives the smoothed rate to all.
    """
    n, k = len(labels), rows.shape[1] if rows.ndim == 2 else len(FEATURES)
    rate = (labels.sum() + 1) / (n + 2)
    weights = np.zeros(k + 1)
    weights[-1] = np.log(rate / (1 - rate))
    if n == 0 or labels.min() == labels.max():
        return weights, np.zeros(k), np.ones(k)
    centre, scale = rows.mean(axis=0), rows.std(axis=0)
    scale[scale < 1e-9] = 1.0
    x = np.c_[(rows - centre) / scale, np.ones(n)]
    penalty = np.r_[np.full(k, PENALTY), 1e-6]
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + np.diag(penalty), x.T @ (labels - p) - penalty * weights)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights, centre, scale


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The classifier, from at most SAMPLE labelled ids with TEXTS different texts each, which is all that comes to the driver.

    Every sampled id counts, however often another is repeated, and the rows are the same in every run.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text")).join(F.broadcast(chosen), "doc_id")
    rows = with_figures(rows).groupBy("doc_id", text_key("_text").alias("_key")).agg(F.max("label").alias("label"), F.min("_x").alias("_x"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy("_key"))
    rows = rows.withColumn("_rank", rank).where(F.col("_rank") <= TEXTS).select("doc_id", "_key", "label", "_x").collect()
    rows.sort(key=lambda r: (r.doc_id, r["_key"]))
    return fit(np.array([r["_x"] for r in rows], dtype=float), np.array([r.label for r in rows], dtype=float))


def log_odds(x: Column, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Column:
    """What the classifier makes of a text's figures, within the bounds of EVIDENCE."""
    weights, centre, scale = model
    total = F.aggregate(
        F.arrays_zip(x.alias("x"), F.array(*(F.lit(float(w / s)) for w, s in zip(weights, scale))).alias("w"), F.array(*(F.lit(float(c)) for c in centre)).alias("c")),
        F.lit(float(weights[-1])), lambda acc, f: acc + (f["x"] - f["c"]) * f["w"],
    )
    return F.greatest(F.least(total, F.lit(EVIDENCE)), F.lit(-EVIDENCE))


class Sites(NamedTuple):
    """Sums of the judged documents by path and host, and what the priors count for.

    ``sums`` has host, path, n, good, host_n, host_good: documents, and the sum of their p_text.
    """

    sums: DataFrame
    prior: float
    host_pull: float
    path_pull: float


def _drawn(n: Column, good: Column, mean: Column | float, pull: float) -> Column:
    """The posterior rate of a site: its documents, and ``pull`` more at the mean above it."""
    return (good + F.lit(pull) * mean) / (n + F.lit(pull))


def site_sums(judged: DataFrame) -> Sites:
    """The sites of (host, path, p_text).

    Sums by path are partly added up before the shuffle; all that follows has a row per path or host.
    """
    paths = stored(judged.groupBy("host", "path").agg(F.count(F.lit(1)).cast("double").alias("n"), F.sum("p_text").alias("good")), "paths")
    hosts = paths.groupBy(F.col("host").alias("_host")).agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_good").alias("good")).collect()[0]
    prior = (whole.good + 0.5) / (whole.n + 1) if whole.n else 0.5
    host_pull = _pull(hosts.select(F.col("host_n").alias("n"), F.col("host_good").alias("good"), F.lit(prior).alias("mean")))
    both = stored(paths.join(hosts, F.col("host").eqNullSafe(F.col("_host"))).drop("_host"), "sites")
    path_pull = _pull(both.select("n", "good", _drawn(F.col("host_n"), F.col("host_good"), F.lit(prior), host_pull).alias("mean")))
    return Sites(both, prior, host_pull, path_pull)


def judged(docs: DataFrame, labels: DataFrame, host: str, path: str, label: str) -> DataFrame:
    """(row, host, path, p_text): ``row`` has the columns of ``docs``, p_text is what the text alone says."""
    model = train(docs, labels, label)
    found = with_figures(docs.select(
        F.struct("*").alias("row"), F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"),
        F.coalesce("text", F.lit("")).alias("_text"),
    ))
    # Never null, and said to be so: a condition on it is not tested beforehand by scoring the text once more.
    p_text = F.coalesce(1 / (1 + F.exp(-log_odds(F.col("_x"), model))), F.lit(0.5))
    return found.select("row", "host", "path", p_text.alias("p_text"))


def with_sites(found: DataFrame, sites: Sites) -> DataFrame:
    """Adds the rates of host and path, without the document itself, and p_quality.

    A document's own text is evidence once: its site says what the others there are like. The only document of a
    path has its host's rate, the only one of a host the corpus rate. The sites are few next to the rows that
    they are joined to.
    """
    sums = sites.sums.withColumnsRenamed({"host": "_host", "path": "_path"})
    met = found.join(sums, F.col("host").eqNullSafe(F.col("_host")) & F.col("path").eqNullSafe(F.col("_path"))).drop("_host", "_path")
    own = F.col("p_text")
    met = met.withColumn("host_rate", _drawn(F.col("host_n") - 1, F.col("host_good") - own, F.lit(sites.prior), sites.host_pull))
    met = met.withColumn("path_rate", _drawn(F.col("n") - 1, F.col("good") - own, F.col("host_rate"), sites.path_pull))
    odds = lambda p: F.log(p / (1 - p))
    total = odds(own) + odds(F.greatest(F.least("path_rate", F.lit(0.999)), F.lit(0.001))) - float(np.log(sites.prior / (1 - sites.prior)))
    return met.withColumn("p_quality", 1 / (1 + F.exp(-total))).drop("n", "good", "host_n", "host_good")


def scores(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", label: str = "quality") -> DataFrame:
    """One row per row: doc_id, host, path, p_text, host_rate, path_rate, p_quality, keep.

    ``keep`` is p_quality of at least one half. A path belongs to its host; the rates are those of the site's other documents. Null hosts and paths are sites
    of their own; null texts count as empty; rows that repeat a doc_id or a text are scored each.
    Without usable labels every document has the same evidence and is kept. An empty
    table gives an empty result; extra columns are ignored.
    """
    found = judged(docs.select("doc_id", "text", host, path), labels, host, path, label)
    found = stored(found.select(F.col("row.doc_id").alias("doc_id"), "host", "path", "p_text"), "judged")
    met = with_sites(found, site_sums(found))
    return met.select("doc_id", "host", "path", "p_text", "host_rate", "path_rate", "p_quality", (F.col("p_quality") >= 0.5).alias("keep"))


def keep(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their columns.

    Texts are scored where they are read, once for the sums and once for the result, and never shuffled.
    """
    found = judged(docs, labels, host, path, label)
    met = with_sites(found, site_sums(found.select("host", "path", "p_text")))
    return met.where("p_quality >= 0.5").select("row.*")


def _pull(sites: DataFrame) -> float:
    """Documents that a prior counts for: large if the sites vary no more than chance would have it.

    Of a beta-binomial: variance between sites beyond sampling, against m (1 - m); sums of four columns only.
    """
    rate = F.col("good") / F.col("n")
    spread = F.col("mean") * (1 - F.col("mean"))
    some = sites.where("n > 1").agg(
        F.count(F.lit(1)).alias("sites"), F.avg((rate - F.col("mean")) * (rate - F.col("mean"))).alias("seen"),
        F.avg(spread / F.col("n")).alias("chance"), F.avg(spread).alias("spread"),
    ).collect()[0]
    if not some.sites or not some.spread:
        return 10.0
    between = max(some.seen - some.chance, 1e-6 * some.spread)
    return float(min(max(some.spread / between - 1, 1.0), 1e6))
