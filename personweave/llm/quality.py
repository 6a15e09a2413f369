"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Training reads the labelled rows of a bounded sample. Each partition adds up its part of the normal equations for every
fold, so what is gathered has the size of the model and not of the data. Because the sums are kept by fold, the weights
that leave a fold out need no second pass; scores of left-out rows feed the calibration. Scoring is one pass over the
documents without a shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = ("log_chars", "log_words", "word_length", "long_words", "distinct_words", "top_word", "repeated_pairs",
              "letters", "upper", "digits", "space", "sentence_marks", "other_marks", "marked_words", "title_words",
              "non_ascii", "lines", "line_words", "repeated_lines", "short_lines", "byte_entropy", "sentence_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_HIGH = np.arange(256) >= 128
_SENTENCE = np.isin(np.arange(256), list(b".,;:?'\"-()"))
_OTHER = ~(_LETTER | _DIGIT | _SPACE | _HIGH | _SENTENCE) & (np.arange(256) > 32)
_CLASSES = np.stack([_LETTER, _UPPER, _DIGIT, _SPACE, _SENTENCE, _OTHER, _HIGH]).astype(np.float64)


def statistics(text: str | None) -> np.ndarray:
    """The STATISTICS of a whole text; shares are 0 for an empty one."""
    data = (text or "").encode()
    size = max(len(data), 1)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letter, upper, digit, space, sentence, other, high = _CLASSES @ counts / size
    words = data.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct = Counter(words)
    top = max(distinct.values(), default=0) / n
    pairs = len(set(zip(words, words[1:]))) if len(words) > 1 else 0
    lines = [x for x in data.split(b"\n") if x.strip()]
    some = max(len(lines), 1)
    p = counts[counts > 0] / size
    ends = counts[46] + counts[33] + counts[63]
    return np.array([
        np.log1p(len(data)), np.log1p(len(words)), lengths.mean() if words else 0.0, (lengths > 12).mean() if words else 0.0,
        len(distinct) / n, top, 1 - pairs / max(len(words) - 1, 1) if len(words) > 1 else 0.0,
        letter, upper, digit, space, sentence, other,
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n, sum(65 <= w[0] <= 90 for w in words) / n,
        high, np.log1p(len(lines)), np.log1p(len(words) / some), 1 - len(set(lines)) / some if lines else 0.0,
        sum(len(x) < 30 for x in lines) / some, float(-(p * np.log2(p)).sum()), np.log1p(len(words) / max(ends, 1))])


@dataclass(frozen=True)
class Settings:
    """`max_rows` bounds the labelled sample that the classifier is fitted on by `tasks` tasks; scoring covers all rows."""
    features: int = 256
    bandwidth: float = 4.0
    ridge: float = 1.0
    folds: int = 5
    max_rows: int = 200_000
    bins: int = 2_000
    tasks: int = 8
    seed: int = 11


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # last row: left out no fold; row k: left out fold k
    knots: np.ndarray
    values: np.ndarray
    settings: Settings

    def raw(self, stats: np.ndarray, fold: np.ndarray | None = None) -> np.ndarray:
        z = fourier(stats, self.mean, self.scale, self.settings)
        return z @ self.weights[-1] if fold is None else np.einsum("ij,ij->i", z, self.weights[fold])

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def fourier(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray, s: Settings) -> np.ndarray:
    """cos(Wx + b) of standardised statistics, the random map that approximates a Gaussian kernel, and a constant."""
    rng = np.random.default_rng(s.seed)
    w = rng.normal(size=(len(STATISTICS), s.features)) / s.bandwidth
    b = rng.uniform(0, 2 * np.pi, s.features)
    x = np.clip((stats - mean) / scale, -6, 6)
    return np.hstack([np.sqrt(2 / s.features) * np.cos(x @ w + b), np.ones((len(stats), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (mean x of each pool) and their non-decreasing values."""
    pools: list[list[float]] = []
    for at in np.argsort(x, kind="stable"):
        pools.append([w[at], w[at] * x[at], w[at] * y[at]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][0] >= pools[-1][2] * pools[-2][0]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top)]
    p = np.array(pools)
    return p[:, 1] / p[:, 0], p[:, 2] / p[:, 0]


def training_rows(docs: DataFrame, labels: DataFrame, learn_from: Column, s: Settings,
                  id_col: str, text_col: str, label_col: str) -> DataFrame:
    """`stats`, `label`, `fold`, `spread` of a sample of at most about `max_rows` labelled documents, chosen by hash of the id."""
    known = (labels.select(labels[f"`{id_col}`"].cast("long").alias("doc_id"), labels[f"`{label_col}`"].alias("label"))
             .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & learn_from)
             .groupBy("doc_id").agg(F.min("label").cast("double").alias("label")))
    share = min(1.0, s.max_rows / max(1, known.count()))
    mark = F.pmod(F.xxhash64("doc_id", F.lit(s.seed)), F.lit(1 << 30))
    chosen = (known.where(mark < int(share * (1 << 30)))
              .withColumns({"fold": F.pmod(F.xxhash64("doc_id"), F.lit(s.folds)).cast("int"), "spread": F.xxhash64("doc_id")}))
    texts = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = pa.array([statistics(t.as_py()) for t in b["text"]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([stats, b["label"], b["fold"], b["spread"]], ["stats", "label", "fold", "spread"])

    # The sample is bounded by max_rows, so it may be broadcast: texts are not shuffled.
    return texts.join(F.broadcast(chosen), "doc_id").select("text", "label", "fold", "spread").mapInArrow(
        run, "stats array<double>, label double, fold int, spread long")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), len(STATISTICS))


def fit(rows: DataFrame, s: Settings) -> Model | None:
    """Fit on `training_rows`; None without any. What reaches the driver has the size of the model times `tasks`."""
    rows = rows.repartition("spread").drop("spread").coalesce(s.tasks).cache()
    try:
        n = len(STATISTICS)
        sums = [F.sum(F.col("stats")[i]).alias(f"a{i}") for i in range(n)]
        squares = [F.sum(F.col("stats")[i] * F.col("stats")[i]).alias(f"b{i}") for i in range(n)]
        total = rows.agg(F.count("*").alias("n"), *sums, *squares).first()
        if not total["n"]:
            return None
        mean = np.array([total[f"a{i}"] for i in range(n)]) / total["n"]
        var = np.array([total[f"b{i}"] for i in range(n)]) / total["n"] - mean ** 2
        scale = np.sqrt(np.maximum(var, 1e-6))
        size = s.features + 1

        def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            left, right = np.zeros((s.folds, size, size)), np.zeros((s.folds, size))
            for b in batches:
                fold, y = b["fold"].to_numpy(), b["label"].to_numpy()
                z = fourier(_matrix(b["stats"]), mean, scale, s)
                for k in range(s.folds):
                    part = z[fold == k]
                    left[k] += part.T @ part
                    right[k] += part.T @ y[fold == k]
            yield pa.RecordBatch.from_arrays([pa.array([left.tobytes()], pa.binary()), pa.array([right.tobytes()], pa.binary())],
                                             ["left", "right"])

        # One sum per partition, `tasks` of them.
        parts = rows.mapInArrow(equations, "left binary, right binary").collect()
        left = sum(np.frombuffer(r["left"]) for r in parts).reshape(s.folds, size, size)
        right = sum(np.frombuffer(r["right"]) for r in parts).reshape(s.folds, size)
        ridge = s.ridge * np.eye(size)
        ridge[-1, -1] = 1e-9
        weights = np.stack([np.linalg.solve(left.sum(0) - left[k] + ridge, right.sum(0) - right[k]) for k in range(s.folds)]
                           + [np.linalg.solve(left.sum(0) + ridge, right.sum(0))])
        model = Model(mean, scale, weights, np.zeros(1), np.zeros(1), s)

        def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                raw = model.raw(_matrix(b["stats"]), b["fold"].to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(raw), b["label"]], ["raw", "label"])

        raw = rows.mapInArrow(left_out, "raw double, label double")
        low, width = -0.5, 2.0 / s.bins
        binned = (raw.groupBy(F.least(F.greatest(F.floor((F.col("raw") - low) / width), F.lit(0)), F.lit(s.bins - 1)).alias("bin"))
                  .agg(F.count("*").alias("n"), F.avg("raw").alias("x"), F.avg("label").alias("y")).orderBy("bin").collect())
        knots, values = isotonic(*(np.array([float(r[c]) for r in binned]) for c in ("x", "y", "n")))
        return Model(mean, scale, weights, knots, values, s)
    finally:
        rows.unpersist()


def score_column(model: Model | None, text: Column) -> Column:
    """Score of a text; 0.5 for all if there was nothing to learn from."""
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        if model is None or not len(texts):
            return pa.array(np.full(len(texts), 0.5))
        return pa.array(model.score(np.stack([statistics(t.as_py()) for t in texts])))
    return score(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, settings: Settings = Settings(),
                   id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", carry: bool = False) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row of `docs`; with `carry` also `record`, all its columns.

    Held-out rows (crc32 of the id modulo 5 is 0, or no id) are never learned from. Scores depend on the text alone.
    Null texts count as empty; empty texts get the score that the model gives to zero statistics. Of several labels of
    one id the lowest counts; labels other than 0 and 1 are ignored. Without any usable label every score is 0.5.
    Repeated rows get equal scores. An empty table gives an empty result.
    """
    rows = training_rows(docs, labels, ~held_out(F.col("doc_id")), settings, id_col, text_col, label_col)
    model = fit(rows, settings)
    key = docs[f"`{id_col}`"].cast("long")
    record = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("record")] if carry else []
    return (docs.select(key.alias("doc_id"), *record, held_out(key).alias("held_out"),
                        score_column(model, docs[f"`{text_col}`"]).alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))
