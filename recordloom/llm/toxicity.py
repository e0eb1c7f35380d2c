"""Toxicity: a convolutional text classifier trained in numpy.

A word is the sum of the hashed embeddings of itself and of its first letters; filters over one, two and three
words are max-pooled over the whole text and weighed by a logistic unit. Training uses at most ``FIT_ROWS``
labelled rows of each class (least hash of the id first), part of which sets, for each language, the margin from
which a text counts as toxic; a score of 0.5 is that margin. The language is told from the text's own frequent words.
Scoring runs over Arrow batches with the model (``BUCKETS`` x ``WIDTH`` numbers) sent to every executor.

NULL and empty texts have no words and a low score. Repeated rows are scored each; repeated
labels of an id count once (the largest). Without labels, or with one class only, all scores are the smoothed share of
toxic labels. Texts of any length are scored whole, in pieces that overlap by the widest filter. Only the id
and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 2_000  # of each class
BUCKETS, WIDTH, FILTERS, SPANS = 1 << 18, 8, 16, (1, 2, 3)
KNOWN_WORDS = 100_000  # a task remembers so many words' embeddings
CHUNK_WORDS = 1 << 16
PREFIXES = (3, 4, 5)

# Very frequent words by language.
LANGUAGE_WORDS = {
    "de": "der die und das ist nicht von zu mit ein eine sich auf für den dem auch als".split(),
    "en": "the of and to in is that it was for on with as are be this by at from".split(),
    "es": "de la que el en y los del se las por un para con una su al no es lo".split(),
    "fr": "le de la et les des est dans un une du pour que qui sur au pas plus ce il en".split(),
}
LANGUAGES = ["", *LANGUAGE_WORDS]

find_words = re.compile(r"[^\W_]+").findall


def language(words: list[str]) -> int:
    """Index into LANGUAGES of the language with the most of its frequent words; 0 if none occurs."""
    counts = [0] + [sum(map(set(LANGUAGE_WORDS[name]).__contains__, words)) for name in LANGUAGES[1:]]
    return int(np.argmax(counts))


def buckets(word: str) -> list[int]:
    """Where the embeddings of a word and of its beginnings stand; 0, which is always nothing, for a beginning it hasn't."""
    keys = [word] + [f"{word[:n]}~" if len(word) >= n else "" for n in PREFIXES]
    return [zlib.crc32(k.encode()) % (BUCKETS - 1) + 1 if k else 0 for k in keys]


@dataclass
class Network:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]  # span -> (span, WIDTH, FILTERS)
    offsets: np.ndarray
    weights: np.ndarray
    bias: float
    margins: np.ndarray  # by language
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.table = np.zeros((1024, WIDTH), np.float32)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "table")} | {"known": {}, "table": np.zeros((1024, WIDTH), np.float32)}

    def vectors(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = list(dict.fromkeys(words))
        if new:
            start = len(known)
            while start + len(new) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[start : start + len(new)] = self.embedding[[buckets(w) for w in new]].sum(1)
            known.update(zip(new, range(start, start + len(new))))
        return self.table[[known[w] for w in words]]

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """The greatest value of every filter over the words ``x``."""
        return np.concatenate([
            sum(x[j : len(x) - span + 1 + j] @ f[j] for j in range(span)).max(0) if len(x) >= span else np.zeros(FILTERS, np.float32)
            for span, f in self.filters.items()
        ])

    def margin(self, text: str) -> float:
        words = find_words(text.lower())
        best, step = None, CHUNK_WORDS - max(SPANS) + 1
        for at in range(0, max(len(words) - max(SPANS) + 1, 1), step):
            part = self.pooled(self.vectors(words[at : at + CHUNK_WORDS]))
            best = part if best is None else np.maximum(best, part)
        z = float(np.maximum(best + self.offsets, 0) @ self.weights) + self.bias
        return z - float(self.margins[language(words)])


def fit(texts: list[str], toxic: np.ndarray, epochs: int = 6, seed: int = 7) -> Network:
    """Train with sparse gradients: only the words that won a maximum move."""
    rng = np.random.default_rng(seed)
    network = Network(
        rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32),
        {s: rng.normal(0, 0.5, (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS},
        np.full(FILTERS * len(SPANS), 0.1, np.float32), rng.normal(0, 0.3, FILTERS * len(SPANS)).astype(np.float32), 0.0, np.zeros(len(LANGUAGES)),
    )
    share = (toxic.sum() + 1) / (len(toxic) + 2)
    if len(texts) < 20 or toxic.min() == toxic.max():
        network.weights[:] = 0
        network.bias = float(np.log(share / (1 - share)))
        return network
    known: dict[str, int] = {}
    docs = [np.array([known.setdefault(w, len(known)) for w in find_words(t.lower())], np.int64) for t in texts]
    places = np.zeros((len(known), 1 + len(PREFIXES)), np.int64)  # 0 stands for no such beginning
    for word, i in known.items():
        places[i] = buckets(word)
    network.embedding[0] = 0
    languages = np.array([language(find_words(t.lower())) for t in texts])
    calibrating = rng.random(len(texts)) < 0.2
    train = np.flatnonzero(~calibrating)
    squares = np.full((BUCKETS, WIDTH), 1e-4, np.float32)
    dense = [*network.filters.values(), network.offsets, network.weights]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(train)
        for at in range(0, len(order), 32):
            batch = order[at : at + 32]
            grads = [np.zeros_like(p) for p in dense]
            rows, steps, bias_grad = [], [], 0.0
            for k in batch:
                ids = docs[k]
                if len(ids) < max(SPANS):
                    continue
                x = network.embedding[places[ids]].sum(1)
                spots, values = [], []
                for span, f in network.filters.items():
                    out = sum(x[j : len(x) - span + 1 + j] @ f[j] for j in range(span))
                    spots.append(out.argmax(0))
                    values.append(out.max(0))
                value = np.concatenate(values) + network.offsets
                hidden = np.maximum(value, 0)
                z = float(hidden @ network.weights) + network.bias
                d = (1 / (1 + np.exp(-z)) - toxic[k]) / len(batch)
                bias_grad += d
                grads[-1] += d * hidden
                back = d * network.weights * (value > 0)
                grads[-2] += back
                for s, (span, f) in enumerate(network.filters.items()):
                    own = back[s * FILTERS : (s + 1) * FILTERS]
                    for j in range(span):
                        where = spots[s] + j
                        grads[s][j] += x[where].T * own
                        rows.append(ids[where])
                        steps.append(f[j].T * own[:, None])
            t += 1
            for p, g, (m, v) in zip(dense, grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
            network.bias -= 0.1 * bias_grad
            if rows:
                at_rows = places[np.concatenate(rows)].ravel()
                moved = np.repeat(np.concatenate(steps), places.shape[1], 0)[at_rows > 0]
                unique, inverse = np.unique(at_rows[at_rows > 0], return_inverse=True)
                total = np.zeros((len(unique), WIDTH), np.float32)
                np.add.at(total, inverse, moved)
                squares[unique] += total**2
                network.embedding[unique] -= 0.1 * total / np.sqrt(squares[unique])
    # Beginnings and words never trained on say nothing.
    seen = np.zeros(BUCKETS, bool)
    seen[places.ravel()] = True
    network.embedding[~seen] = 0
    network.embedding[0] = 0
    margins = np.array([network.margin(texts[i]) for i in np.flatnonzero(calibrating)])
    truth, spoken = toxic[calibrating] > 0, languages[calibrating]
    overall = _threshold(margins, truth, 0.0)
    for i in range(len(LANGUAGES)):
        network.margins[i] = _threshold(margins[spoken == i], truth[spoken == i], overall)
    return network


def _threshold(margins: np.ndarray, truth: np.ndarray, fallback: float, least: int = 10) -> float:
    """The middle of the margins that make the least of mistakes; the fallback where a class has too few rows.

    Toxic texts are the rarer ones: missing one weighs as much as the root of clean to toxic rows false alarms, halfway
    between counting all mistakes alike and both classes alike.
    """
    if truth.sum() < least or (~truth).sum() < least:
        return fallback
    order = np.argsort(margins)
    values, right = margins[order], truth[order]
    # Cutting before position i calls everything from i on toxic.
    missed = max(1.0, float(np.sqrt((~truth).sum() / truth.sum())))
    wrong = missed * np.concatenate([[0], np.cumsum(right)]) + np.concatenate([np.cumsum(~right[::-1])[::-1], [0]])
    best = np.flatnonzero(wrong == wrong.min())
    lows = values[np.maximum(best - 1, 0)]
    highs = values[np.minimum(best, len(values) - 1)]
    widest = np.argmax(highs - lows)
    return float((lows[widest] + highs[widest]) / 2)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS) -> Network:
    """Fit on labelled rows that are not held out, at most ``rows`` of each class, chosen by the hash of their id."""
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy("doc_id").agg(F.max(label).alias("label"))
    first = lambda wanted: usable.filter(F.col("label") == wanted).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = first(0).union(first(1)).select(F.col("doc_id").alias("l_id"), "label")
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))  # bounded by 2 x ``rows``
    found = texts.groupBy("l_id").agg(F.max("label").alias("label"), F.max(F.coalesce("text", F.lit(""))).alias("text")).orderBy("l_id").toPandas()
    return fit(found["text"].tolist(), (found["label"].to_numpy() > 0).astype(float))


def toxicity_scores(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id and score of every row."""
    model = docs.sparkSession.sparkContext.broadcast(network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = np.array([model.value.margin(text or "") for text in batch.column(1).to_pylist()], float)
            scores = 1 / (1 + np.exp(-np.clip(margins, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    kept = docs.select("doc_id", "text")
    return kept.mapInArrow(run, f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, score double")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents")
    scored = toxicity_scores(docs, learn(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
