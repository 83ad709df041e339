"""Quality classifier: document evidence, shrunk through site and path posteriors (empirical Bayes)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.storage import written

#: At most so many labelled rows are fitted; which ones is decided by a hash of the id.
FIT_ROWS = 20_000
FEATURES = ("signs", "capitals", "bars", "distinct_words", "word_chars", "log_words", "short_lines")


def features(text: Column) -> dict[str, Column]:
    """Shares and means of the whole text, computed by Spark's own functions."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    n_words = F.size(words)
    chars, some = F.greatest(F.length(text), F.lit(1)), F.greatest(n_words, F.lit(1))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / chars
    return {
        "signs": share(r"[^\p{L}\p{N}\s.,]"),
        "capitals": share(r"\p{Lu}"),
        "bars": share(r"\|"),
        "distinct_words": F.size(F.array_distinct(words)) / some,
        "word_chars": F.least(chars / some, F.lit(50.0)),
        "log_words": F.log1p(n_words.cast("double")),
        "short_lines": F.regexp_count(text, F.lit(r"\n")) / some,
    }


def _features(text: Column) -> Column:
    return F.array(*(c.cast("double") for c in features(text).values()))


class Logistic:
    """Ridge logistic regression on standardised features, with squares."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = rows.mean(0), rows.std(0) + 1e-6
        x = self._inputs(rows)
        self.weights = np.zeros(x.shape[1])
        penalty = np.full(x.shape[1], ridge)
        penalty[0] = 1e-6
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            slope = x.T @ (p - labels) + penalty * self.weights
            curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
            step = np.linalg.solve(curve, slope)
            self.weights -= step
            if np.abs(step).max() < 1e-8:
                break

    def _inputs(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        return np.hstack([np.ones((len(z), 1)), z, z * z])

    def column(self, array: str) -> Column:
        """The same score as a Spark expression (log-odds)."""
        score = F.lit(float(self.weights[0]))
        n = len(self.mean)
        for k in range(n):
            z = (F.col(array)[k] - F.lit(float(self.mean[k]))) / F.lit(float(self.scale[k]))
            z = F.greatest(F.least(z, F.lit(6.0)), F.lit(-6.0))
            score = score + F.lit(float(self.weights[1 + k])) * z + F.lit(float(self.weights[1 + n + k])) * z * z
        return score


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> Logistic | None:
    """Classifier fitted on at most ``FIT_ROWS`` labelled rows; None if a class is missing."""
    marked = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).alias("__q_label"))
    marked = marked.orderBy(F.xxhash64(id_col), id_col).limit(FIT_ROWS)
    marked = written(marked.select(F.col(id_col).alias("id"), "__q_label"), "quality-labels")
    known = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(marked), "id")  # FIT_ROWS rows at most
    rows = known.select(_features(F.col("text")).alias("__q_features"), "__q_label").orderBy(F.xxhash64("__q_features"), "__q_label").limit(FIT_ROWS).collect()
    y = np.array([float(r["__q_label"] > 0) for r in rows])
    if not rows or y.min() == y.max():
        return None
    return Logistic(np.array([r["__q_features"] for r in rows]), y)


def _strength(mean: float, between: float) -> float:
    """Pseudo-count of a beta prior whose variance is ``between`` (method of moments), 1 to a million."""
    return float(np.clip(mean * (1 - mean) / max(between, 1e-9) - 1, 1.0, 1e6))


def _between(groups: DataFrame, parent_mean: Column) -> float:
    """Variance of group means around their parents beyond what documents inside a group explain."""
    row = groups.agg(
        F.sum(F.col("n") * (F.col("s") / F.col("n") - parent_mean) ** 2),
        F.sum(F.col("ss") - F.col("s") * F.col("s") / F.col("n")),
        F.sum("n"),
        F.sum(F.col("n").cast("double") ** 2),
        F.count(F.lit(1)),
    ).first()
    spread, within, total, squares, count = (float(v or 0) for v in row)
    if count < 2 or total <= count:
        return 0.0
    noise = within / (total - count)
    return max(0.0, (spread - (count - 1) * noise) / max(total - squares / total, 1e-9))


def _drawn(total: Column, n: Column, weight: float, parent: Column) -> Column:
    """Posterior mean of a group of ``n`` values, drawn to its parent's mean with the force of ``weight`` values."""
    return (total + weight * parent) / (n + weight)


def site_sums(scored: DataFrame) -> tuple[DataFrame, float, float, float]:
    """(host, path, n, s, host_n, host_s) from (host, path, p), the global mean, and the pseudo-counts of hosts and paths.

    A host's posterior mean is drawn to the global mean, a path's to its host's; how
    far depends on its number of documents and on how much groups differ in the data.
    Only one row per path leaves the grouped aggregation.
    """
    paths = written(
        scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") * F.col("p")).alias("ss")), "quality-paths"
    )
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "s", "ss")))
    total = hosts.agg(F.sum("s"), F.sum("n")).first()
    mean = total[0] / total[1] if total[1] else 0.5
    host_weight = _strength(mean, _between(hosts, F.lit(mean)))
    hosts = hosts.select(F.col("host").alias("of_host"), F.col("n").alias("host_n"), F.col("s").alias("host_s"))
    nested = paths.join(hosts, F.expr("host <=> of_host")).drop("of_host")
    path_weight = _strength(mean, _between(nested, _drawn(F.col("host_s"), F.col("host_n"), host_weight, F.lit(mean))))
    return written(nested.select("host", "path", "n", "s", "host_n", "host_s"), "quality-sites"), mean, host_weight, path_weight


def _judged(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, host: str, path: str, threshold: float) -> DataFrame:
    """(row, quality): every row as one struct, and its judgement."""
    model = fit(docs, labels, id_col, text_col, label_col)
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"), _features(docs[text_col]).alias("features"), F.expr(host).cast("string").alias("host"), F.expr(path).cast("string").alias("path")
    )
    odds = model.column("features") if model else F.lit(0.0)
    scored = rows.select("row", "host", "path", odds.alias("odds"))
    scored = scored.withColumn("p", 1 / (1 + F.exp(-F.col("odds"))))
    sites, mean, host_weight, path_weight = site_sums(scored.select("host", "path", "p"))
    joined = scored.alias("d").join(sites.alias("g"), F.expr("d.host <=> g.host AND d.path <=> g.path"), "left")
    others = lambda total: F.greatest(F.col(total) - F.col("p"), F.lit(0.0))  # noqa: E731  the sum without the row itself
    joined = joined.withColumn("host_posterior", _drawn(others("host_s"), F.col("host_n") - 1, host_weight, F.lit(mean)))
    joined = joined.withColumn("path_posterior", _drawn(others("s"), F.col("n") - 1, path_weight, F.col("host_posterior")))
    clipped = F.greatest(F.least(F.col("path_posterior"), F.lit(1 - 1e-9)), F.lit(1e-9))
    mean = min(max(mean, 1e-9), 1 - 1e-9)
    final = 1 / (1 + F.exp(-(F.col("odds") + F.log(clipped / (1 - clipped)) - float(np.log(mean / (1 - mean))))))
    quality = F.struct("d.host", "d.path", F.col("p").alias("doc_probability"), "host_posterior", "path_posterior", final.alias("probability"), (final >= threshold).alias("kept"))
    return joined.select("row", quality.alias("quality"))


def judge_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", host: str = "source", path: str = "concat(source, '/', lang)", threshold: float = 0.5
) -> DataFrame:
    """``docs`` with a struct ``_quality``: host, path, doc_probability, host_posterior, path_posterior, probability, kept.

    ``host`` and ``path`` are SQL expressions over the table; NULL is a group of its
    own. The classifier's odds are multiplied by the odds of the path's posterior over
    the global odds; both posteriors are those of the other rows, so that no row is its
    own witness, and a row alone on its path is judged by its host. ``kept`` is
    probability >= threshold. NULL and empty texts are judged like any text, by their
    features. Labels without id or value are left out, of several labels of a document
    the best counts; with labels of one class only, everything has the probability 0.5
    and is kept. Repeated documents give repeated rows; an empty table none. A column
    ``_quality`` of the table is replaced.
    """
    judged = _judged(docs, labels, id_col, text_col, label_col, host, path, threshold)
    own = [c for c in docs.columns if c.lower() != "_quality"]
    return judged.select(*(F.col("row")[c].alias(c) for c in own), F.col("quality").alias("_quality"))


def drop_low_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", host: str = "source", path: str = "concat(source, '/', lang)", threshold: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, with all their columns."""
    return _judged(docs, labels, id_col, text_col, label_col, host, path, threshold).where("quality.kept").select("row.*")
