"""Document quality with site evidence: a document classifier, shrunk host and path posteriors, and their combination.

1. A logistic regression on text measures gives each document's own probability p of good quality.
2. Each document lends its site evidence: its label, or p at a lower weight. Grouped sums per host and per path (a part of a host).
3. Empirical Bayes: the global mean m and the strength of the prior come from the spread between hosts, by moments; a host's
   posterior mean is (strength * m + good) / (strength + all). Paths are shrunk towards their host in the same way. A sparse
   site stays near what is above it.
4. A document's odds are its classifier odds times the odds ratio of its path's posterior to the global mean. The document's own
   evidence is taken out of its site first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.common import written
from seriesloom.llm.quality_rules import measured

#: Bound of the labelled rows that the classifier is fitted on.
TRAIN_ROWS = 50_000
#: Weight of a document without a label in its site's evidence; score from which a document is kept.
UNLABELLED, LEAST = 0.2, 0.5
#: Copies of each site's row in the join back, so that a hot site goes to as many tasks.
SALTS = 32
FEATURES = ("length", "symbols", "repeated_lines", "repeated_words", "capitals", "word_length", "exclamations", "digits")


def url_host(url: Column) -> Column:
    """The lower-case host of an address, null where there is none."""
    found = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def url_path(url: Column) -> Column:
    """The first segment of an address's path, empty at the root."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def features(docs: DataFrame, host: Column, path: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, host, path (null-safe keys) and the features of every row; null text counts as empty."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("none"))
    named = docs.select(docs[doc_id].alias("doc_id"), key(host).alias("host"), key(path).alias("path"), docs[text].alias("text"))
    m = measured(named, "text", ("doc_id", "host", "path"))
    t, n, chars = F.col("t"), F.greatest("m.n_words", F.lit(1)), F.greatest("m.word_chars", F.lit(1))
    count = lambda signs: F.char_length(t) - F.char_length(F.translate(t, signs, ""))
    made = (
        F.log1p("m.n_words") / 5, 2 * F.least(F.col("m.n_symbols") / n, F.lit(0.5)), F.col("m.n_dup_lines") / F.greatest("m.n_lines", F.lit(1)), F.col("m.n_repeat_words") / n,
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ") / chars, chars / n / 10, count("!") / n, count("0123456789") / chars,
    )
    return m.select("k.*", *[F.least(c.cast("double"), F.lit(3.0)).alias(name) for c, name in zip(made, FEATURES)])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 30) -> np.ndarray:
    """Logistic regression with a ridge, by Newton steps; the last weight is the constant."""
    x = np.column_stack((x, np.ones(len(x))))
    w = np.zeros(x.shape[1])
    pull = np.full(x.shape[1], ridge)
    pull[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _strength(groups: float, mean: float, weight: float, squares: float, spread: float) -> float:
    """Strength of a beta prior by moments: spread = sum N (rate - mean)^2 over groups, squares = sum N^2 / weight."""
    inside = mean * (1 - mean)
    between = (spread - (groups - 1) * inside) / max(weight - squares, 1e-9)
    return float(np.clip(inside / between - 1, 1.0, 1e6)) if between > 0 and inside > 0 else 1e6


def posteriors(evidence: DataFrame) -> tuple[DataFrame, float, float, float]:
    """host, path, weight -> (per path the sums of path and host), global mean, strengths of the priors of hosts and of paths.

    ``evidence`` has host, path, y (0 to 1) and w. Only one row of moments per level comes to the driver.
    """
    paths = evidence.groupBy("host", "path").agg(F.sum(F.col("w") * F.col("y")).alias("good"), F.sum("w").alias("all"))
    hosts = paths.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("all").alias("host_all"))
    sites = written(paths.join(hosts.withColumnRenamed("host", "of"), F.col("host") == F.col("of")).drop("of"))
    hosts = sites.select("host", "host_good", "host_all").distinct()
    total = hosts.agg(F.sum("host_good").alias("g"), F.sum("host_all").alias("n")).first()
    mean = float(np.clip(total.g / total.n, 1e-4, 1 - 1e-4)) if total.n else 0.5
    rate = F.col("host_good") / F.col("host_all")
    one = hosts.agg(F.count("*").alias("h"), F.sum("host_all").alias("n"), F.sum(F.col("host_all") ** 2).alias("q"), F.sum(F.col("host_all") * (rate - mean) ** 2).alias("s")).first()
    k_host = _strength(one.h, mean, one.n, one.q / one.n, one.s) if one.h else 1e6
    inner = (F.lit(k_host * mean) + F.col("host_good")) / (F.lit(k_host) + F.col("host_all"))
    two = sites.agg(F.count("*").alias("h"), F.sum("all").alias("n"), F.sum(F.col("all") ** 2).alias("q"), F.sum(F.col("all") * (F.col("good") / F.col("all") - inner) ** 2).alias("s")).first()
    k_path = _strength(two.h - one.h + 1, mean, two.n, two.q / two.n, two.s) if two.h else 1e6
    return sites, mean, k_host, k_path


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, text: str = "text", doc_id: str = "doc_id", label: str = "quality",
             train_rows: int = TRAIN_ROWS, unlabelled: float = UNLABELLED, least: float = LEAST) -> DataFrame:
    """doc_id, classifier, site (path posterior without the document itself), score and kept for every row of ``docs``.

    ``labels`` has ``doc_id`` and ``label`` (1 good, 0 bad); repeated labels of a document are averaged, null ones left out. The classifier is
    fitted on at most about ``train_rows`` labelled rows, chosen by a hash of doc_id; without labels of both kinds it says 0.5. A null
    host or path is a site of its own. A null doc_id has no label. Repeated rows get equal results; an empty table gives none. Other columns are not read.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("labelled_id")).agg(F.avg(F.col(label).cast("double")).alias("y"))
    rows = features(docs, host, path, text, doc_id)
    rows = written(rows.join(known, F.col("doc_id") == F.col("labelled_id"), "left").drop("labelled_id"))
    taught = rows.where("y IS NOT NULL")
    n = taught.count()
    rate = min(1.0, train_rows / max(n, 1))
    sample = taught.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < rate * 1_000_000).select(*FEATURES, "y").toPandas()
    y = sample["y"].to_numpy(np.float64)
    w = fit(sample[list(FEATURES)].to_numpy(np.float64), y) if len(y) and y.min() < 0.5 < y.max() else np.zeros(len(FEATURES) + 1)
    linear = F.lit(float(w[-1]))
    for c, weight in zip(FEATURES, w):
        linear = linear + F.lit(float(weight)) * F.col(c)
    odds = lambda p: F.log(p / (1 - p))
    clipped = lambda p: F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    scored = rows.withColumn("classifier", 1 / (1 + F.exp(-F.greatest(F.least(linear, F.lit(30.0)), F.lit(-30.0)))))
    scored = scored.select("doc_id", "host", "path", "classifier", F.coalesce("y", "classifier").alias("y"), F.when(F.col("y").isNull(), unlabelled).otherwise(1.0).alias("w"))
    sites, mean, k_host, k_path = posteriors(scored.select("host", "path", "y", "w"))
    spread = sites.select(F.col("host").alias("h"), F.col("path").alias("p"), "good", "all", "host_good", "host_all", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"))
    salt = F.pmod(F.xxhash64("doc_id", "classifier"), F.lit(SALTS)).cast("int")
    joined = scored.withColumn("salt", salt).join(spread, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")) & (F.col("salt") == F.col("s")))
    own = F.col("w") * F.col("y")
    above = (F.lit(k_host * mean) + F.col("host_good") - own) / (F.lit(k_host) + F.col("host_all") - F.col("w"))
    site = clipped((F.lit(k_path) * above + F.col("good") - own) / (F.lit(k_path) + F.col("all") - F.col("w")))
    score = 1 / (1 + F.exp(-(odds(clipped(F.col("classifier"))) + odds(site) - F.lit(float(np.log(mean / (1 - mean)))))))
    return joined.select("doc_id", "classifier", site.alias("site"), score.alias("score"), (score >= least).alias("kept"))
