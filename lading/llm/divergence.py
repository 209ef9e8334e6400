"""How the vocabularies of sources differ, by chunk factorization.

A chunk is a run of characters other than the six ASCII blanks, a term a run of A-Z, a-z and
characters beyond ASCII inside a chunk, with A-Z lower-cased. Blanks end terms, so the terms of a text
are those of its chunks. Steps:

1. every document's chunks are counted; a task adds up the documents and occurrences of a chunk per
   language and source, and gives one row for each chunk of a language, with those counts in arrays;
2. the rows meet by chunk, once. Their counts are added up, every distinct chunk of the whole table
   is tokenized, and its terms join the counts, all where the chunk is;
3. occurrences of a term add up over its chunks. Documents do not, where one holds a term in two
   chunks, but the largest and the summed count of a term's chunks bound them. Only for terms with
   ``least_docs`` between the two are documents looked up again: a second pass over the texts gives
   the chunks of those terms, found by a Bloom filter of at most ``FILTER_BITS`` and then by a
   join, and counts each document once;
4. shares of kept terms are compared, groups of a language with each other in blocks of terms, as
   matrices of terms and sources, so that no row is made for a pair at a term.

All arithmetic is in integers. A share is 1 + floor(scale * (count + 2) / (N + 2 * V)), a divergence
floor((p - q)^2 / (p + q)), summed over all kept terms of the language. Sources travel as 64-bit
hashes, whose seed is changed until no two sources share one.

Defined results: null texts, languages and sources count as empty strings. Every row is a document,
repeated rows too. Groups without a term, and languages without a kept term, have pairs of value 0.
Ties go to the smaller item in UTF-8 order. Extra columns are passed over.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import discard, stored
from .words import pieces, word_hashes

HELD_CHUNKS = 400_000
HELD_ENTRIES = 2_000_000
LONG_TEXT = 1 << 22
FILTER_BITS = 1 << 27
FILTER_PROBES = 4
CELLS = 1 << 16
SCALE = 1_000_000_000
TERM = r"([^\x00-\x40\x5B-\x60\x7B-\x7F]+)"


class Numbered(dict):
    """Things and the numbers they came with."""

    def __missing__(self, thing) -> int:
        self[thing] = number = len(self)
        return number


class Counts:
    """Documents and occurrences by (language, source) and chunk, until they are taken out."""

    def __init__(self):
        self.chunks, self.groups = Numbered(), Numbered()
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.entries = 0

    def add(self, groups: list[tuple], texts: list[bytes | None]) -> None:
        split = [t.split() if t else () for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        chunk = np.fromiter(
            map(self.chunks.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        # One entry for every chunk of a document.
        key = np.sort(np.repeat(np.arange(len(split)), sizes) << 32 | chunk)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        group = np.fromiter(map(self.groups.__getitem__, groups), np.int64, len(groups))
        times = np.diff(np.append(first, len(key)))
        self.waiting.append(((key[first] & 0xFFFFFFFF) << 24 | group[key[first] >> 32], times))
        self.entries += len(first)

    @property
    def full(self) -> bool:
        return self.entries >= HELD_ENTRIES or len(self.chunks) >= HELD_CHUNKS or (
            len(self.groups) >> 24 > 0)

    def taken(self) -> Iterator[pa.RecordBatch]:
        """(lang, chunk, codes, docs, occurrences), a row for each chunk of a language."""
        if not self.entries:
            return
        names = list(self.groups)
        # Groups are numbered anew, so that those of one language stand together.
        order = sorted(range(len(names)), key=lambda k: names[k])
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        langs = [names[k][0] for k in order]
        codes = np.array([names[k][1] for k in order], np.int64)
        lang = np.cumsum([0, *(a != b for a, b in zip(langs, langs[1:]))])
        key, times = (np.concatenate(part) for part in zip(*self.waiting))
        key = (key >> 24) << 24 | place[key & 0xFFFFFF]
        by_key = np.argsort(key, kind="stable")
        key, times = key[by_key], times[by_key]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        docs, occurrences = np.diff(np.append(first, len(key))), np.add.reduceat(times, first)
        group = key[first] & 0xFFFFFF
        row = (key[first] >> 24) << 24 | lang[group]
        start = np.flatnonzero(np.diff(row, prepend=-1))
        ends = pa.array(np.append(start, len(row)).astype(np.int32))
        strings = pa.array(list(self.chunks), pa.binary()).cast(pa.string())
        yield pa.RecordBatch.from_arrays([
            pa.array(langs, pa.string()).take(pa.array(group[start])),
            strings.take(pa.array(row[start] >> 24)),
            pa.ListArray.from_arrays(ends, pa.array(codes[group])),
            pa.ListArray.from_arrays(ends, pa.array(docs)),
            pa.ListArray.from_arrays(ends, pa.array(occurrences)),
        ], ["lang", "chunk", "codes", "docs", "occurrences"])
        self.__init__()


def chunk_counts(docs: DataFrame) -> DataFrame:
    """(lang, chunk, codes, docs, occurrences): partial counts of ``docs`` (lang, code, text)."""
    def run(batches):
        counts = Counts()
        for piece, texts in pieces(batches):
            counts.add(
                list(zip(piece.column("lang").to_pylist(), piece.column("code").to_pylist())), texts)
            if counts.full:
                yield from counts.taken()
        yield from counts.taken()

    return docs.select("lang", "code", "text").mapInArrow(
        run, "lang string, chunk string, codes array<long>, docs array<long>,"
             " occurrences array<long>")


def chunk_terms(counts: DataFrame) -> DataFrame:
    """(lang, chunk, term, times, docs, groups) of every distinct chunk that has a term: how often it
    holds the term, its documents in the language, and its occurrences by source."""
    at = F.explode(F.arrays_zip("codes", "docs", "occurrences"))
    # One exchange, by chunk; all that follows stays where the chunk is.
    by_source = counts.repartition("chunk").select("lang", "chunk", at.alias("g")).groupBy(
        "chunk", "lang", "g.codes").agg(
        F.sum("g.docs").alias("docs"), F.sum("g.occurrences").alias("occurrences"))
    # A group has as many rows as there are sources, then as there are languages.
    by_lang = by_source.groupBy("chunk", "lang").agg(
        F.sum("docs").alias("docs"),
        F.collect_list(F.struct(F.col("codes").alias("code"), "occurrences")).alias("groups"))
    by_chunk = by_lang.groupBy("chunk").agg(
        F.collect_list(F.struct("lang", "docs", "groups")).alias("langs"))
    lowered = F.translate("chunk", string.ascii_uppercase, string.ascii_lowercase)
    found = F.regexp_extract_all(lowered, F.lit(TERM), F.lit(1))
    tokenized = by_chunk.select("chunk", "langs", found.alias("found"))
    each = tokenized.select(
        "chunk", "langs", "found", F.explode(F.array_distinct("found")).alias("term"))
    times = F.size(F.filter("found", lambda f: f == F.col("term"))).cast("long")
    return each.select("chunk", "term", times.alias("times"), F.inline("langs"))


class Filter:
    """A Bloom filter over hashes."""

    def __init__(self, bits: int):
        self.words = np.zeros(bits // 64, np.uint64)
        self.mask = np.uint64(bits - 1)

    def _places(self, hashes: np.ndarray, probe: int) -> tuple[np.ndarray, np.ndarray]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        at = (hashes + np.uint64(probe) * step) & self.mask
        return at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))

    def add(self, hashes: np.ndarray) -> None:
        for probe in range(FILTER_PROBES):
            np.bitwise_or.at(self.words, *self._places(hashes, probe))

    def held(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes it holds, by place."""
        left = np.arange(len(hashes))
        for probe in range(FILTER_PROBES):
            word, bit = self._places(hashes[left], probe)
            left = left[(self.words[word] & bit) != 0]
        return left


def filter_of(chunks: DataFrame, count: int) -> Filter:
    """A filter over ``chunks``, of 16 bits for each as far as ``FILTER_BITS`` go."""
    bits = min(FILTER_BITS, max(1 << 16, 1 << (16 * count - 1).bit_length()))

    def run(batches):
        held = Filter(bits)
        for _, chunks in pieces(batches, "chunk"):
            held.add(word_hashes(np.frombuffer(b" ".join(chunks), np.uint8))[2])
        at = np.flatnonzero(held.words)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(held.words[at].view(np.int64))], ["at", "word"])

    made = Filter(bits)
    words = chunks.select("chunk").mapInArrow(run, "at long, word long").groupBy("at").agg(
        F.bit_or("word").alias("word")).toArrow()
    made.words[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return made


def documents_with(docs: DataFrame, held: Filter) -> DataFrame:
    """(lang, chunk, row): the chunks of every document that the filter holds."""
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches):
        held, row = sent.value, TaskContext.get().partitionId() << 40
        for piece, texts in pieces(batches):
            # Of a very long text its distinct chunks are enough.
            texts = [
                t or b"" if not t or len(t) <= LONG_TEXT else b" ".join(set(t.split())) for t in texts]
            blob = b" ".join(texts)
            begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
            start, stop, hashes = word_hashes(np.frombuffer(blob, np.uint8))
            hit = held.held(hashes)
            at = np.searchsorted(begin, start[hit], "right") - 1
            # Once for each document.
            order = np.lexsort((hashes[hit], at))
            hit, at = hit[order], at[order]
            new = np.ones(len(hit), bool)
            new[1:] = (at[1:] != at[:-1]) | (hashes[hit[1:]] != hashes[hit[:-1]])
            hit, at = hit[new], at[new]
            found = [blob[a:b] for a, b in zip(start[hit].tolist(), stop[hit].tolist())]
            yield pa.RecordBatch.from_arrays([
                piece.column("lang").take(pa.array(at)),
                pa.array(found, pa.binary()).cast(pa.string()), pa.array(at + row)],
                ["lang", "chunk", "row"])
            row += len(texts)

    return docs.select("lang", "text").mapInArrow(run, "lang string, chunk string, row long")


def kept_terms(docs: DataFrame, joined: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term) that stand in ``least_docs`` documents of the language or more."""
    bounds = stored(joined.groupBy("lang", "term").agg(
        F.max("docs").alias("low"), F.sum("docs").alias("high")).filter(
        F.col("high") >= least_docs), "bounds")
    sure = bounds.filter(F.col("low") >= least_docs).select("lang", "term")
    undecided = bounds.filter(F.col("low") < least_docs).select("lang", "term")
    chunks = stored(joined.select("lang", "chunk", "term").join(undecided, ["lang", "term"]), "open")
    count = chunks.count()
    if not count:
        return sure
    found = documents_with(docs, filter_of(chunks, count))
    exact = found.join(chunks, ["lang", "chunk"]).select("lang", "term", "row").distinct().groupBy(
        "lang", "term").agg(F.count("*").alias("docs"))
    return sure.union(exact.filter(F.col("docs") >= least_docs).select("lang", "term"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a term, in units of one in ``SCALE``."""
    wide = "decimal(38,0)"
    over = (F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)")).cast(wide)
    return F.lit(1).cast("long") + F.call_function(
        "div", over, (total + 2 * terms).cast(wide)).cast("long")


def apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, code, other, value): divergences of groups of one language, over its kept terms."""
    sizes = groups.groupBy("lang").agg(
        F.first("terms").alias("terms"), F.count("*").alias("sources")).filter("terms > 0").select(
        "lang", F.ceil(F.col("terms") * F.col("sources") / CELLS).cast("int").alias("blocks"))
    none = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    # Every block has a row for each group, with the share of terms that the group lacks.
    lacking = groups.join(sizes, "lang").select(
        "lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "code",
        F.lit(None).cast("string").alias("term"), none.alias("p"))
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    held = cells.join(sizes, "lang").select("lang", block.alias("block"), "code", "term", "p")

    def run(group: pa.Table) -> pa.Table:
        marks = group.filter(pc.is_null(group.column("term")))
        cells = group.filter(pc.is_valid(group.column("term")))
        codes = marks.column("code").to_numpy()
        by_code = np.argsort(codes)
        codes, none = codes[by_code], marks.column("p").to_numpy()[by_code]
        terms = cells.column("term").combine_chunks().dictionary_encode()
        terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
        p = np.tile(none, (len(terms.dictionary), 1))
        p[terms.indices.to_numpy(), np.searchsorted(codes, cells.column("code").to_numpy())] = (
            cells.column("p").to_numpy())
        n = len(codes)
        value = np.empty((n, n), np.int64)
        for k in range(n):
            q = p[:, k:k + 1]
            value[k] = ((p - q) ** 2 // (p + q)).sum(axis=0)
        a, b = np.nonzero(~np.eye(n, dtype=bool))
        lang = group.column("lang")[0].as_py()
        return pa.table({
            "lang": pa.array([lang] * len(a), pa.string()), "code": codes[a], "other": codes[b],
            "value": value[a, b]})

    return held.unionByName(lacking).groupBy("lang", "block").applyInArrow(
        run, "lang string, code long, other long, value long"
    ).groupBy("lang", "code", "other").agg(F.sum("value").alias("value"))


def _groups_of(plain: DataFrame) -> tuple[DataFrame, Column]:
    """(lang, source, code) of every group, and how a source becomes its code."""
    groups = stored(plain.select("lang", "source").distinct(), "groups")
    seed = 0
    while True:
        code = F.xxhash64(F.lit(seed), "source")
        names, codes = groups.agg(F.count_distinct("source"), F.count_distinct(code)).first()
        if names == codes:
            return groups.withColumn("code", code), code
        seed += 1


def divergence(
    docs: DataFrame, least_docs: int = 10, top: int = 10, text: str = "text", lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` compares the sources of a language, part
    ``term`` lists the ``top`` terms that a source has more of than its language."""
    plain = docs.select(*(
        F.coalesce(F.col(c), F.lit("")).alias(name)
        for name, c in (("lang", lang), ("source", source), ("text", text))))
    named, code = _groups_of(plain)
    coded = plain.select("lang", code.alias("code"), "text")
    joined = stored(chunk_terms(chunk_counts(coded)), "terms")
    kept = stored(kept_terms(coded, joined, least_docs), "kept")
    # By (lang, term) once: the terms that are kept, their counts by source, and those of the language.
    every = Window.partitionBy("lang", "term")
    counted = stored(
        joined.join(kept, ["lang", "term"]).select("lang", "term", "times", F.inline("groups"))
        .groupBy("lang", "term", "code").agg(
            F.sum(F.col("times") * F.col("occurrences")).alias("count"))
        .withColumn("lang_count", F.sum("count").over(every)), "counted")
    discard(joined)

    sizes = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = counted.groupBy("lang", "code").agg(F.sum("count").alias("total"))
    groups = named.join(sizes, "lang", "left").join(totals, ["lang", "code"], "left").fillna(
        0, ["terms", "total"]).withColumn(
        "lang_total", F.sum("total").over(Window.partitionBy("lang")))
    groups = stored(groups, "groups")
    cells = stored(counted.join(groups, ["lang", "code"]).select(
        "lang", "code", "source", "term",
        share(F.col("count"), F.col("total"), F.col("terms")).alias("p"),
        share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q")), "cells")

    sides = groups.select("lang", "source", "code")
    pairs = sides.join(
        sides.select("lang", F.col("source").alias("item"), F.col("code").alias("other")), "lang"
    ).filter("source <> item").join(
        _pair_sums(cells.select("lang", "code", "term", "p"), groups),
        ["lang", "code", "other"], "left"
    ).select("lang", "source", F.lit("pair").alias("part"), "item",
             F.coalesce("value", F.lit(0)).alias("value"))
    more = cells.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        apart(F.col("p"), F.col("q")).alias("value"))
    order = F.row_number().over(
        Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    return pairs.select("*", order).union(
        more.select("*", order).filter(F.col("rank") <= top))
