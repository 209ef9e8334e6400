"""Language identification by interpolated Kneser-Ney character models.

One model per language, all of order four, over the characters of words (a word's rim counts as a
character). The highest order counts occurrences, the lower ones count distinct left contexts;
every order is discounted and interpolated with the next lower one, down to equal characters.
The n-grams of an order are 64-bit hashes in one sorted array shared by all languages, with one row
of probabilities (and of back-off weights) per language beside it; a lookup is a binary search.

A text goes to the language with the lowest cross-entropy per character. Characters depend on their
word only, so the log-probabilities of a word are worked out once and kept in a bounded memo.
Rejection is calibrated on the training sample: per language the cross-entropy that one in a
thousand of its texts exceeds; a text beyond that is marked ``rejected``, its best language kept.

The models are fitted on at most ``sample_docs`` texts per language, those with the smallest hash
of text and id; all texts are scored whole.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Ties go to the
language first in code-point order. Texts without a language, or with a null id, teach nothing.
Without any language all texts are ``und``. Repeated rows get the same answer; extra columns are
passed over.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .words import mix, pieces

ORDER = 4
SAMPLE_DOCS = 400
DISCOUNT = 0.75
MEMO_WORDS = 150_000
LOT = 4096
CHARACTERS = 1 << 12


def _grams(words: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams that end at every character of the words (and at their end), for
    n = 1 to ORDER; shorter contexts at a word's start begin with its rim. And the words' starts."""
    text = " ".join(words) + " "
    data = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.cumsum(sizes) - sizes
    place = np.arange(len(data)) - np.repeat(starts, sizes)
    hashes, grams = mix(data + np.uint64(1)), []
    for n in range(1, ORDER + 1):
        if n > 1:
            before = np.full(len(data), 32, np.uint64)
            before[n - 1:] = data[:len(data) - n + 1]
            before[place < n - 1] = 32
            hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + before + np.uint64(n))
        grams.append(hashes)
    return grams, starts


def _contexts(words: list[str]) -> list[np.ndarray]:
    """Hashes of what stands before every character, for n-grams of n = 2 to ORDER."""
    text = " ".join(words) + " "
    data = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    place = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes, found = np.full(len(data), 7, np.uint64), []
    for n in range(2, ORDER + 1):
        before = np.full(len(data), 32, np.uint64)
        before[n - 1:] = data[:len(data) - n + 1]
        before[place < n - 1] = 32
        hashes = mix(hashes * np.uint64(0xD6E8FEB86659FD93) + before + np.uint64(n))
        found.append(hashes)
    return found


class Models:
    """Sorted hash arrays: per order keys with discounted probabilities, contexts with weights."""

    def __init__(self, languages: list[str], tables: list, weights: list):
        self.languages, self.tables, self.weights = languages, tables, weights
        self.memo: dict[str, int] = {}
        self.rows = np.zeros((0, len(languages)))

    @staticmethod
    def _look(keys: np.ndarray, rows: np.ndarray, at: np.ndarray, missing: float) -> np.ndarray:
        if not len(keys):
            return np.full((len(at), rows.shape[1]), missing)
        found = np.minimum(np.searchsorted(keys, at), len(keys) - 1)
        return np.where((keys[found] == at)[:, None], rows[found], missing)

    def spell(self, words: list[str]) -> np.ndarray:
        """Natural-log probability of every word, its end included, by language."""
        grams, starts = _grams(words)
        contexts = _contexts(words)
        p = self._look(*self.tables[0], grams[0], 0.0) + self.weights[0] / CHARACTERS
        for n in range(1, ORDER):
            p = self._look(*self.tables[n], grams[n], 0.0) + p * self._look(
                *self.weights[n], contexts[n - 1], 1.0)
        return np.add.reduceat(np.log(p), starts, axis=0)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Nats per character of every text by language, and its number of characters."""
        split = [t.split() for t in texts]
        flat = [w for words in split for w in words]
        new = list(dict.fromkeys(w for w in flat if w not in self.memo))
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            self.rows = self.rows[:0]
            new = list(dict.fromkeys(flat))
        lots = [self.spell(new[k:k + LOT]) for k in range(0, len(new), LOT)]
        self.memo.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.rows = np.concatenate([self.rows, *lots])
        at = np.fromiter(map(self.memo.__getitem__, flat), np.int64, len(flat))
        of = np.repeat(np.arange(len(texts)), [len(words) for words in split])
        sums = np.stack([
            np.bincount(of, column, len(texts)) for column in self.rows[at].T
        ], axis=1) if len(self.languages) else np.zeros((len(texts), 0))
        length = np.array([sum(map(len, words)) + len(words) for words in split])
        return -sums / np.maximum(length, 1)[:, None], length


def fit(texts: list[list[str]], languages: list[str]) -> Models:
    """Kneser-Ney models of the languages, given some texts of each."""
    count = len(languages)
    tables, weights = [], []
    grams = [[] for _ in range(ORDER)]
    contexts = [[] for _ in range(ORDER)]
    times = []
    for k in range(count):
        # Every distinct word is taken apart once, and counts as often as it occurs.
        often = Counter(w for t in texts[k] for w in t.split())
        words = list(often)
        times.append(np.repeat(
            np.fromiter(often.values(), np.int64, len(words)),
            np.fromiter(map(len, words), np.int64, len(words)) + 1))
        made, _ = _grams(words) if words else ([np.empty(0, np.uint64)] * ORDER, None)
        before = _contexts(words) if words else [np.empty(0, np.uint64)] * (ORDER - 1)
        for n in range(ORDER):
            grams[n].append(made[n])
            contexts[n].append(before[n - 1] if n else np.zeros(len(made[0]), np.uint64))
    for n in range(ORDER):
        top = n == ORDER - 1
        keys = np.unique(np.concatenate(grams[n])) if count else np.empty(0, np.uint64)
        heads = np.unique(np.concatenate(contexts[n])) if count else np.empty(0, np.uint64)
        p = np.zeros((len(keys), count))
        backing = np.ones((len(heads), count))
        for k in range(count):
            g, c = grams[n][k], contexts[n][k]
            if not len(g):
                continue
            if not top:
                # Distinct (left context, n-gram): the distinct n-grams of the next order.
                _, first = np.unique(grams[n + 1][k], return_index=True)
                g, c = g[first], c[first]
            mine, first, inverse = np.unique(g, return_index=True, return_inverse=True)
            number = np.bincount(inverse, times[k] if top else None)
            head = np.searchsorted(heads, c[first])
            total = np.bincount(head, number, len(heads))
            kinds = np.bincount(head, minlength=len(heads))
            p[np.searchsorted(keys, mine), k] = (number - DISCOUNT) / total[head]
            seen = total > 0
            backing[seen, k] = DISCOUNT * kinds[seen] / total[seen]
        tables.append((keys, p))
        weights.append((heads, backing) if n else (backing[0] if len(backing) else np.ones(count)))
    return Models(languages, tables, weights)


def _letters(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def identify(
    docs: DataFrame, trains: Column, id_column: str = "doc_id", text: str = "text",
    language: str = "lang", sample_docs: int = SAMPLE_DOCS,
) -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score`` (0 to 1), ``cross_entropy`` in bits per
    character, ``rejected``."""
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(text).alias("text"),
        F.col(language).alias("lang"), F.coalesce(trains, F.lit(False)).alias("trains"))
    taught = rows.filter("trains and lang is not null and text is not null and id is not null")
    counts = taught.groupBy("lang").agg(F.count("*").alias("n"))
    # Hashes are even, so about eight times the sample lies below the limit and only that is
    # sorted; where a language has fewer texts, all do. One row per language is sent along, and
    # the models hold every language anyway.
    place = F.shiftrightunsigned(F.xxhash64("text", "id"), 1)
    below = F.col("place") < F.col("n").cast("double") ** -1 * (8.0 * sample_docs * 2.0 ** 63)
    order = Window.partitionBy("lang").orderBy("place", "text")
    sample = (
        taught.select("lang", "text", place.alias("place"))
        .join(F.broadcast(counts), "lang").filter(below)
        .withColumn("nth", F.row_number().over(order))
        .filter(F.col("nth") <= sample_docs).select("lang", "text").toArrow()
    )
    languages = sorted(set(sample.column("lang").to_pylist()))
    by_language: dict[str, list[str]] = {name: [] for name in languages}
    for name, value in zip(sample.column("lang").to_pylist(), sample.column("text").to_pylist()):
        by_language[name].append(value)
    texts = [sorted(by_language[name]) for name in languages]
    models = fit(texts, languages)
    limits = np.array([
        np.quantile(models.entropies(part)[0][:, k], 0.999) for k, part in enumerate(texts)
    ] or [0.0]) * 1.1
    models.memo, models.rows = {}, models.rows[:0]
    sent = docs.sparkSession.sparkContext.broadcast(
        (languages, models.tables, models.weights, limits))

    def run(batches):
        names, tables, weights, limits = sent.value
        models = Models(names, tables, weights)
        for piece, values in pieces(batches):
            decoded = [(t or b"").decode() for t in values]
            entropy, length = models.entropies(decoded)
            usable = np.array([_letters(t) for t in decoded]) & bool(names)
            if names:
                best = entropy.argmin(axis=1)
                lowest = entropy[np.arange(len(best)), best]
                # Evidence grows with the text, but characters of a word are no free draws.
                odds = np.exp(-np.minimum(
                    (entropy - lowest[:, None]) * np.sqrt(length)[:, None] * 4, 700))
                score = np.where(usable, 1 / odds.sum(axis=1), 0.0)
                rejected = ~usable | (lowest > limits[best])
            else:
                best, lowest = np.zeros(len(decoded), int), np.zeros(len(decoded))
                score, rejected = np.zeros(len(decoded)), np.ones(len(decoded), bool)
            yield pa.RecordBatch.from_arrays([
                piece.column(0),
                pa.array([names[b] if u else "und" for b, u in zip(best, usable)], pa.string()),
                pa.array(score), pa.array(np.where(usable, lowest / np.log(2), 0.0)),
                pa.array(rejected),
            ], ["id", "lang_pred", "score", "cross_entropy", "rejected"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "text").mapInArrow(
        run, f"id {kind}, lang_pred string, score double, cross_entropy double, rejected boolean"
    ).withColumnRenamed("id", id_column)
