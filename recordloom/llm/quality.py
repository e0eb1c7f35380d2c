"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees over a sample of labelled texts propose rules: the path to each of their nodes is a
conjunction of bounds on statistics. A logistic model with a lasso penalty weighs the rules, most of them
with nothing. The remaining rules become Spark column expressions, so scoring is one pass of built-in
functions. Only the statistics of at most ``FIT_ROWS`` labelled rows (least hash of the id first) reach the
driver; everything else runs over all rows.

NULL and empty texts have all statistics at zero and are scored like any other. Repeated rows are scored each;
repeated labels of an id count once (the largest). Without labels, or with one class only, every
text gets the smoothed share of good labels. Only the id and text columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 12_000
GOOD_FROM = 0.7

# Very frequent words of the languages at hand.
STOP_WORDS = "the of and to in is that it as with de la que el en los del un der die und das ist von zu le les et des est du une".split()


def statistics(text: Column) -> dict[str, Column]:
    """What the rules look at. Rates are per word or per character and zero for empty texts."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    n_words, n_chars = F.size(words), F.char_length(text)
    per_word = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(n_words, F.lit(1))
    per_char = lambda pattern: F.regexp_count(text, F.lit(pattern)) / F.greatest(n_chars, F.lit(1))
    return {
        "words": F.log1p(n_words.cast("double")),
        "word_length": n_chars / F.greatest(n_words, F.lit(1)),
        "distinct": F.size(F.array_distinct(words)) / F.greatest(n_words, F.lit(1)),
        "longest": F.log1p(F.coalesce(F.array_max(F.transform(words, F.char_length)), F.lit(0)).cast("double")),
        "upper": per_char(r"\p{Lu}"),
        "digits": per_char(r"[0-9]"),
        "symbols": per_word(r"[#$%&*~^<>{}=+@\\]"),
        "bars": per_word(r"\|"),
        "bangs": per_word(r"[!?]"),
        "stops": per_word(rf"(?i)(?<!\S)(?:{'|'.join(STOP_WORDS)})(?![^\s.,;:!?])"),
        "ends": per_word(r"[.!?](?=\s|$)"),
        "commas": per_word(r","),
        "again": per_word(r"(?<!\S)(\S+)(?=\s\1(?!\S))"),
        "lines": per_word(r"\n"),
        "marks": per_char(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"),
    }


@dataclass(frozen=True)
class Rule:
    """All ``bounds`` (statistic, above, value) hold: value < x if above, else x <= value."""

    bounds: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[Rule, ...]

    def score(self) -> Column:
        """The probability of the good class, from the columns of ``statistics``."""
        total = F.lit(self.bias)
        for rule in self.rules:
            met = F.lit(True)
            for name, above, value in rule.bounds:
                met = met & (F.col(name) > value if above else F.col(name) <= value)
            total = total + F.when(met, rule.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def _tree(x: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, hessian: np.ndarray, depth: int, least: int):
    """A regression tree on binned statistics: its node paths (feature, above, bin) and the value of each row."""
    paths, values = [], np.zeros(len(x))

    def grow(rows: np.ndarray, path: tuple) -> None:
        g, h = gradient[rows], hessian[rows]
        best = (1e-6, None)
        if len(path) < depth and len(rows) >= 2 * least:
            total = g.sum() ** 2 / (h.sum() + 1)
            for f in range(x.shape[1]):
                bins = len(edges[f]) + 1
                gs, hs = np.bincount(x[rows, f], g, bins).cumsum()[:-1], np.bincount(x[rows, f], h, bins).cumsum()[:-1]
                n = np.bincount(x[rows, f], minlength=bins).cumsum()[:-1]
                gain = gs**2 / (hs + 1) + (g.sum() - gs) ** 2 / (h.sum() - hs + 1) - total
                gain[(n < least) | (len(rows) - n < least)] = 0
                if len(gain) and gain.max() > best[0]:
                    best = gain.max(), (f, int(gain.argmax()))
        if path:
            paths.append(path)
        if best[1] is None:
            values[rows] = -g.sum() / (h.sum() + 1)
            return
        f, b = best[1]
        low = x[rows, f] <= b
        grow(rows[low], (*path, (f, False, b)))
        grow(rows[~low], (*path, (f, True, b)))

    grow(np.arange(len(x)), ())
    return paths, values


def fit(names: list[str], x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, penalty: float = 0.002, most: int = 80) -> Ensemble:
    """Rules from boosted trees, weighed by logistic regression with a lasso penalty (accelerated proximal gradient)."""
    share = (y.sum() + 1) / (len(y) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(y) < 20 or y.min() == y.max():
        return Ensemble(prior, ())
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(x.shape[1])], 1)
    margin, found = np.full(len(y), prior), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        paths, values = _tree(binned, edges, p - y, p * (1 - p), depth, max(5, len(y) // 400))
        margin += 0.3 * values
        for path in paths:
            met = np.ones(len(y), bool)
            for f, above, b in path:
                met &= (binned[:, f] > b) == above
            found.setdefault(met.tobytes(), (path, met))
    paths = [p for p, _ in found.values()]
    r = np.stack([m for _, m in found.values()], 1).astype(np.float64)
    scale = np.sqrt(np.maximum(r.mean(0) * (1 - r.mean(0)), 1e-6))
    r /= scale
    step = 4 / np.linalg.norm(r.T @ r / len(y), 2)
    while True:
        w = v = np.zeros(r.shape[1])
        b, t = prior, 1.0
        for _ in range(400):
            error = 1 / (1 + np.exp(-(r @ v + b))) - y
            new = v - step * (r.T @ error) / len(y)
            new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
            b -= error.mean()
            t, old = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            v, w = new + (old - 1) / t * (new - w), new
        if np.count_nonzero(w) <= most:
            break
        penalty *= 1.5
    bounds = lambda path: tuple((names[f], above, float(edges[f][b])) for f, above, b in path)
    return Ensemble(float(b), tuple(Rule(bounds(paths[i]), float(w[i] / scale[i])) for i in np.flatnonzero(w)))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and one column per statistic."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in statistics(text).items()])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> Ensemble:
    """Fit on labelled rows that are not held out; at most ``rows`` of them, chosen by the hash of their id."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    sample = usable.groupBy("doc_id").agg(F.max(label).alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = sample.select(F.col("doc_id").alias("l_id"), "label")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))  # bounded by ``rows``
    texts = texts.select(F.col("l_id").alias("doc_id"), "label", "text")
    names = list(statistics(F.lit("")))
    stats = texts.select("doc_id", "label", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in statistics(F.coalesce("text", F.lit(""))).items()])
    found = stats.groupBy("doc_id").agg(F.max("label").alias("label"), *[F.max(n).alias(n) for n in names]).orderBy("doc_id").toPandas()
    return fit(names, found[names].to_numpy(float).reshape(-1, len(names)), (found["label"].to_numpy() > 0).astype(float))


def quality_scores(docs: DataFrame, model: Ensemble) -> DataFrame:
    """doc_id and score of every row."""
    return with_statistics(docs).select("doc_id", model.score().alias("score"))


def keep_good(docs: DataFrame, model: Ensemble, least: float = GOOD_FROM) -> DataFrame:
    """The rows, with all columns, whose score is ``least`` or more."""
    text = F.coalesce("text", F.lit(""))
    whole = docs.select(F.struct("*").alias("row"), *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in statistics(text).items()])
    return whole.filter(model.score() >= least).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    scored = quality_scores(docs, learn(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= GOOD_FROM, 1).otherwise(0).alias("predicted")
    )
