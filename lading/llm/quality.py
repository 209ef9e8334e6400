"""Quality classifier: histogram gradient-boosted trees over statistics of a document.

The statistics are made in one pass over whole texts. Training takes a bounded sample of labelled
rows (at most ``sample_rows``, those with the smallest hash of their text, so the choice does not
depend on how rows lie in files); everything else covers all rows. Trees are grown on 64-bin histograms and
flattened into arrays (feature, threshold, children, value), which numpy walks level by level for
a whole batch of documents at once.

Defined results: a null text is scored as an empty one, and empty texts get a score like any other.
Labels are joined by id; a null label or id teaches nothing; several labels of one id are averaged
and count as 1 from one half on. Without labels of both classes every score is the mean label
(0.5 without any). Extra columns are passed over; repeated rows get the same score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .words import pieces

SAMPLE_ROWS = 20_000
BINS = 64
FEATURES = (
    "log_words", "chars_per_word", "symbols", "bars", "marks", "digits", "capitals", "breaks",
    "stops", "distinct", "adjacent", "short_words", "line_words", "repeated_lines",
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!?;:\"'()[]{}=+/\\@^~_`")] = True


def statistics(text: bytes | None) -> list[float]:
    """One number per entry of ``FEATURES``; ratios are per word, per character or per line."""
    text = text or b""
    words = text.split()
    n = max(len(words), 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = max(len(text) - int(counts[128:192].sum()), 1)
    letters = max(int(counts[97:123].sum() + counts[65:91].sum()), 1)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return [
        float(np.log1p(len(words))), (chars - int(counts[32])) / n,
        int(counts[_SYMBOLS].sum()) / n, int(counts[124]) / n, int(counts[_MARKS].sum()) / n,
        int(counts[48:58].sum()) / chars, int(counts[65:91].sum()) / letters,
        int(counts[10]) / n, int(counts[46] + counts[44]) / n, len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        int(np.count_nonzero(np.fromiter(map(len, words), np.int64, len(words)) < 4)) / n,
        len(words) / max(len(lines), 1),
        1 - len(set(lines)) / len(lines) if lines else 0.0,
    ]


def with_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, pick, x): ``x`` the statistics of the document, ``pick`` a hash of its text."""
    def run(batches):
        for piece, texts in pieces(batches):
            rows = np.array([statistics(t) for t in texts], np.float32)
            yield pa.RecordBatch.from_arrays([
                piece.column(0), piece.column(1),
                pa.ListArray.from_arrays(
                    np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES), rows.ravel()),
            ], ["id", "pick", "x"])

    return docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text, id_column).alias("pick"),
        F.col(text).alias("text"),
    ).mapInArrow(run, "id long, pick long, x array<float>")


@dataclass(frozen=True)
class Forest:
    """Trees of one depth, flattened: row t, node i has children 2i+1 and 2i+2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of statistics."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if self.feature.ndim == 2 else 0
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
    l2: float = 1.0,
) -> Forest:
    """Boosts complete trees of a depth on the logistic loss, on histograms of binned columns."""
    inner, leaves = 2 ** depth - 1, 2 ** depth
    mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    if len(np.unique(y)) < 2:
        empty = np.zeros((0, inner))
        return Forest(base, empty.astype(int), empty, np.zeros((0, leaves)))
    columns = x.shape[1]
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS)[1:-1])) for j in range(columns)]
    binned = np.stack(
        [np.searchsorted(edges[j], x[:, j], side="left") for j in range(columns)], axis=1)
    total = np.full(len(y), base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, curvature = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature = np.zeros(inner, np.int64)
        threshold = np.full(inner, np.inf)
        first = 0
        for level in range(depth):
            width = 2 ** level
            local = node - first
            gains = np.full((width, columns, BINS), -np.inf)
            for j in range(columns):
                slot = local * BINS + binned[:, j]
                g = np.bincount(slot, gradient, width * BINS).reshape(width, BINS).cumsum(1)
                h = np.bincount(slot, curvature, width * BINS).reshape(width, BINS).cumsum(1)
                g_all, h_all = g[:, -1:], h[:, -1:]
                gain = (
                    g ** 2 / (h + l2) + (g_all - g) ** 2 / (h_all - h + l2)
                    - g_all ** 2 / (h_all + l2))
                cuts = len(edges[j])
                gains[:, j, :cuts] = np.where((h > 1e-3) & (h_all - h > 1e-3), gain, -np.inf)[:, :cuts]
            best = gains.reshape(width, -1).argmax(1)
            cut = np.full(width, BINS)
            for k in range(width):
                j, b = divmod(int(best[k]), BINS)
                if gains[k, j, b] > 1e-6:
                    feature[first + k], threshold[first + k], cut[k] = j, edges[j][b], b
            chosen = feature[first:first + width]
            right = binned[np.arange(len(y)), chosen[local]] > cut[local]
            node = 2 * node + 1 + right
            first = 2 * first + 1
        leaf = node - inner
        value = -rate * np.bincount(leaf, gradient, leaves) / (
            np.bincount(leaf, curvature, leaves) + l2)
        total += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(base, np.array(features), np.array(thresholds), np.array(values))


def fit(
    measured: DataFrame, labels: DataFrame, label: str, teaches: Column,
    sample_rows: int = SAMPLE_ROWS, id_column: str = "doc_id",
) -> Forest:
    """Learns ``label`` from at most ``sample_rows`` labelled rows whose ``id`` ``teaches``."""
    marks = labels.filter(F.col(id_column).isNotNull() & F.col(label).isNotNull()).groupBy(
        F.col(id_column).cast("long").alias("id")).agg(F.avg(label).alias("y"))
    rows = (
        measured.filter(teaches).join(marks, "id").orderBy("pick", "id").limit(sample_rows)
        .select("x", (F.col("y") >= 0.5).cast("double").alias("y")).toArrow()
    )
    x = rows.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    y = rows.column("y").to_numpy()
    return grow(x.reshape(-1, len(FEATURES)).astype(np.float64), y)


def scored(measured: DataFrame, forest: Forest) -> DataFrame:
    """(id, pick, score) of every measured document."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(2).flatten().to_numpy(zero_copy_only=False)
                score = forest.score(x.reshape(-1, len(FEATURES)).astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(score)], ["id", "pick", "score"])

    return measured.select("id", "pick", "x").mapInArrow(run, "id long, pick long, score double")
