"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of a word position is the shifted sum of the hashes of the last two words, so a
position's value depends on nothing before them. A chunk ends where that value is the strict
minimum among the three positions on either side: boundaries follow the content alone, insertions
move them no further than a few words, and no chunk (but the first and last of a text) has fewer than four
words, about seven on average. Where values tie, longer sums of eight words decide.

They still tie where a period of one to three words goes on for longer than that. Such a stretch
breaks every twelve words, from the first place on where the least rotation of its period begins:
stretches of one period have the same chunks, however long they are and whatever surrounds them.
Next to them chunks may be shorter than four words. No chunk has more than ``LONGEST`` words;
what could be longer (values that fall all the way) breaks after that many.

What is compared are windows, the shortest stretches of adjacent chunks with at least
``least_words`` words: from every chunk onwards, and up to every chunk where that is another
stretch. So all stretches of that length or longer are covered by their own windows. Windows meet
by a 64-bit digest of all their words (blanks do not count); the first one, by document id and
place, stays, and a later one is a repeat of a passage that stands there as a whole. Chunks that
were each seen somewhere, but not side by side, are everyday phrases and stay. Windows that
overlap form one run.

A repeated passage of more than 50 words holds whole chunks with 20 words or more in all but about
one case in a thousand (of 51 random words; longer ones are surer). The words at its two rims, up
to the next boundary, are not part of a chunk that repeats and stay.

Only (digest, document, place) is shuffled. Digests that occur once drop out in an aggregate that
combines before the shuffle; the hottest digests are joined by broadcast and stay spread.

Defined results: null, empty and blank texts have no chunks. Rows are told apart by id and text:
full repeats of a row count as one document, rows that share only the id as different ones. A null
id orders first. Texts keep their blanks, less those of the words removed; other columns, whatever
their names, are handed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored
from .joins import join_hot
from .words import Hashes, mix, pieces

GEAR_WORDS = 2
TIE_WORDS = 8
REACH = 3
PERIODIC_WORDS = 12
LONGEST = 64
LEAST_WORDS = 20


def gear(hashes: np.ndarray, words: int = GEAR_WORDS) -> np.ndarray:
    """Rolling hash at every word of the last few words."""
    rolled = hashes.copy()
    for k in range(1, words):
        rolled[k:] += hashes[:-k] << np.uint64(k)
    return mix(rolled)


def _periodic_breaks(hashes: np.ndarray):
    """Word positions at which chunks begin in every long stretch of a period of up to REACH words."""
    for period in range(1, REACH + 1):
        same = hashes[period:] == hashes[:-period]
        if np.count_nonzero(same) < TIE_WORDS:
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], same, [False]]).view(np.int8)))
        for begin, end in edges.reshape(-1, 2)[np.diff(edges)[::2] >= TIE_WORDS].tolist():
            unit = hashes[begin:begin + period].tolist()
            if period > 1 and len(set(unit)) == 1:
                continue
            turn = min(range(period), key=lambda k: unit[k:] + unit[:k])
            yield np.arange(begin + turn, end + period + 1, PERIODIC_WORDS)


def chunk_starts(hashes: np.ndarray) -> np.ndarray:
    """Word positions at which chunks begin, the first being 0."""
    n = len(hashes)
    if not n:
        return np.empty(0, np.int64)
    rolled = gear(hashes)
    low, tied = np.ones(n, bool), np.zeros(n, bool)
    for k in range(1, REACH + 1):
        low[k:] &= rolled[k:] <= rolled[:-k]
        low[:-k] &= rolled[:-k] <= rolled[k:]
        same = rolled[k:] == rolled[:-k]
        tied[k:] |= same
        tied[:-k] |= same
    if (low & tied).any():
        longer = gear(hashes, TIE_WORDS)
        for k in range(1, REACH + 1):
            differ = rolled[k:] != rolled[:-k]
            low[k:] &= differ | (longer[k:] < longer[:-k])
            low[:-k] &= differ | (longer[:-k] < longer[k:])
    low[-1:] = False
    begins = np.zeros(n + 1, bool)
    begins[1:] = low
    for breaks in _periodic_breaks(hashes):
        begins[breaks[0]:breaks[-1]] = False
        begins[breaks] = True
    begins[0], begins[n] = True, False
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, n))
    if lengths.max() <= LONGEST:
        return starts
    return np.concatenate([
        np.arange(s, s + length, LONGEST) for s, length in zip(starts, lengths)])


def digests(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit digest per chunk, of its words in their order."""
    place = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    weight = mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    return mix(np.add.reduceat(mix(hashes ^ weight) * weight, starts))


def windows(starts: np.ndarray, n: int, least_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shortest stretches of chunks with ``least_words`` words: first chunk, and chunk after the last."""
    limits = np.append(starts, n)
    chunk = np.arange(len(starts))
    after = np.searchsorted(limits, starts + least_words)
    onwards = after < len(limits)
    begin = np.searchsorted(limits, limits[1:] - least_words, "right") - 1
    other = (begin >= 0) & (after[begin] != chunk + 1)
    return (np.concatenate([chunk[onwards], begin[other]]),
            np.concatenate([after[onwards], chunk[other] + 1]))


def window_digests(chunks: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """One digest per window, of its chunks' digests in their order."""
    total = np.zeros(len(first), np.uint64)
    for k in range(int((after - first).max(initial=0))):
        weight = mix(np.array([k + 1], np.uint64)) | np.uint64(1)
        inside = first + k < after
        total[inside] += mix(chunks[first[inside] + k] ^ weight) * weight
    return mix(total)


def _chunked(batches):
    memo = Hashes()
    for piece, texts in pieces(batches):
        split = [t.split() if t else [] for t in texts]
        hashes = memo.of([w for words in split for w in words])
        ends = np.cumsum([len(words) for words in split])
        yield piece, texts, split, [
            hashes[end - len(words):end] for end, words in zip(ends, split)]


def window_table(docs: DataFrame, least_words: int) -> DataFrame:
    """(id, row, place, last, begin, end, digest) of every window: its first and last chunk, and
    its words from ``begin`` up to ``end``. ``docs`` has ``id``, ``row`` and ``text``."""
    def run(batches):
        for piece, _, _, hashed in _chunked(batches):
            rows, columns = [], []
            for k, h in enumerate(hashed):
                if len(h) < least_words:
                    continue
                starts = chunk_starts(h)
                limits = np.append(starts, len(h))
                first, after = windows(starts, len(h), least_words)
                rows.append(np.full(len(first), k))
                columns.append((first, after - 1, limits[first], limits[after],
                                window_digests(digests(h, starts), first, after)))
            if not rows:
                continue
            at = pa.array(np.concatenate(rows))
            *places, found = (np.concatenate(c) for c in zip(*columns))
            yield pa.RecordBatch.from_arrays([
                piece.column(0).take(at), piece.column(1).take(at),
                *(pa.array(p.astype(np.int32)) for p in places), pa.array(found.view(np.int64)),
            ], ["id", "row", "place", "last", "begin", "end", "digest"])

    return docs.select("id", "row", "text").mapInArrow(
        run, "id long, row long, place int, last int, begin int, end int, digest long")


def _keyed(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("row"),
        F.col(text).alias("text"))


def repeated_runs(
    docs: DataFrame, least_words: int = LEAST_WORDS, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Runs of chunks that occur earlier: (id, row, first_place, last_place, words, first_id).

    ``first_id`` is the document that keeps the first window of the run.
    """
    table = stored(window_table(_keyed(docs, id_column, text), least_words), "windows")
    first = F.min(F.struct("id", "row", "place"))
    repeated = table.groupBy("digest").agg(
        first.alias("first"), F.max(F.struct("id", "row", "place")).alias("final"),
        F.count("*").alias("size"),
    ).filter("size > 1 and first < final").drop("final")
    found = join_hot(
        table, stored(repeated, "repeated"), "digest", "size"
    ).filter(F.struct("id", "row", "place") > F.col("first")).select(
        "id", "row", "place", "last", "begin", "end", F.col("first.id").alias("first_id"))
    # One exchange by document serves the removal of repeated rows, the windows and the runs.
    found = found.repartition("id", "row").groupBy("id", "row", "place", "last").agg(
        *(F.first(c).alias(c) for c in ("begin", "end", "first_id")))
    one = Window.partitionBy("id", "row").orderBy("place", "last")
    before = F.max("last").over(one.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("place") > before, F.lit(True)).cast("int")
    return (
        found.withColumn("apart", apart).withColumn("island", F.sum("apart").over(one))
        .groupBy("id", "row", "island")
        .agg(F.min("place").alias("first_place"), F.max("last").alias("last_place"),
             (F.max("end") - F.min("begin")).alias("words"),
             F.min_by("first_id", F.struct("place", "last")).alias("first_id"))
        .drop("island")
    )


def _blank_runs(text: bytes, words: list[bytes]) -> np.ndarray:
    """Byte offsets at which the words of a text begin, and the text's length."""
    data = np.frombuffer(text, np.uint8)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    return np.append(begins, len(text))


def without_runs(docs: DataFrame, runs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``docs`` with the runs cut out of their texts; all columns keep names and order."""
    schema = docs.schema
    names = docs.columns
    # Own names for everything, so that the columns of ``docs`` may be called anything.
    plain = docs.toDF(*[f"c{k}" for k in range(len(names))])
    t = f"c{names.index(text)}"
    keyed = plain.withColumns({
        "_id": F.col(f"c{names.index(id_column)}").cast("long"), "_row": F.xxhash64(t)})
    spans = runs.groupBy("id", "row").agg(
        F.collect_list(F.struct("first_place", "last_place")).alias("_spans"))
    touched = keyed.join(
        spans, keyed._id.eqNullSafe(spans.id) & (keyed._row == spans.row), "left"
    ).select(*plain.columns, "_spans")

    def run(batches):
        memo = Hashes()
        for batch, texts in pieces(batches, t):
            at = batch.schema.get_field_index(t)
            for k, cut in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if cut:
                    value = texts[k]
                    words = value.split()
                    starts = chunk_starts(memo.of(words))
                    begins = _blank_runs(value, words)
                    limit = np.append(starts, len(words))
                    kept, done = [], 0
                    for span in sorted(cut, key=lambda s: s["first_place"]):
                        kept.append(value[done:begins[limit[span["first_place"]]]])
                        done = begins[limit[span["last_place"] + 1]]
                    texts[k] = b"".join([*kept, value[done:]])
            columns = batch.columns[:-1]
            columns[at] = pa.array(texts, pa.binary()).cast(batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])

    cleaned = touched.mapInArrow(run, plain.schema)
    return cleaned.toDF(*names).to(schema) if len(set(names)) == len(names) else cleaned.toDF(*names)


def substring_dedup(
    docs: DataFrame, least_words: int = LEAST_WORDS, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` without the passages that occur in an earlier place."""
    runs = stored(repeated_runs(docs, least_words, id_column, text), "runs")
    return without_runs(docs, runs, id_column, text)
