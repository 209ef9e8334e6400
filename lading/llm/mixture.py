"""Language-model scores by logistic mixing of hashed-context bit predictors.

A text is its words (A-Z lower-cased), each with a blank behind it, and one more blank as its end.
The model runs over these bytes from the first to the last and predicts each as eight binary
decisions. Five predictors look at the last one, two, three, four and six bytes, across the ends of
words, and the bits decided so far, hashed into tables of counts. Their logits are summed with
weights picked by bit and by the longest context that has been seen (the gate), the weights being
learned online: predict, then step along the error. A table of counts over (bits so far, quantised
logit) refines the result, again after predicting. While learning, a byte's own occurrence is left
out of the counts. The probabilities of the mixed bits alone make the score, and those of all texts
add up to one at most.

A byte and the six before it, all that its predictors look at, are a gram, which has one
probability. Every byte of every training text is counted, per gram by tasks that combine before the
shuffle; contexts and weights are learned from the grams, each as often as it occurs. The online
passes go over groups of grams picked and ordered by a hash, so that partitions make no difference,
and their results meet weighted by what each has seen. Tasks remember the probabilities of grams.

Only tables of a bounded size reach the driver: contexts (as large as the number of grams asks for,
up to ``ORDERS``), weights, and the ``top_words`` most frequent words, which are looked up for
``base_score`` while reading the texts; the other, rare words of a text get theirs by a join on the
word. No word is left out.

Defined results: a null text counts as empty: one token, the end. Texts with a null id are scored,
not learned from and not held out. Without any training text all spellings are equally likely
bits and ``base_score`` is 0. Extra columns are passed over; repeated rows are texts of their own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stored
from .words import mix, pieces

# Bytes a predictor looks at, and the bits of its largest table.
ORDERS = ((1, 16), (2, 18), (3, 20), (4, 21), (6, 22))
SLOTS = sum(1 << bits for _, bits in ORDERS)
LEAST_BITS = 16
FULL_BITS = tuple(bits for _, bits in ORDERS)
GATES = 8 * (len(ORDERS) + 1)
STEPS = 33
TOP_WORDS = 200_000
GRAMS_AT_ONCE = 2048
SCORED_AT_ONCE = 1 << 14
GROUP_GRAMS = 1 << 17
SORTED_BYTES = 1 << 22
HELD_GRAMS = 3_000_000
MEMO_BITS = 22
FREE = np.uint64(1 << 63)
# The tables of three bytes and more lie in as many regions as this has bits, by the last three
# bytes: tasks that have the grams of a region to themselves share no slot of it.
REGION_BITS = 6
SHARED = sum(order < 3 for order, _ in ORDERS)


def grams(texts: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Of every byte of some texts, given as words, the byte and the six before it as a number, the
    byte highest; and the number of bytes of each text."""
    lead = b"\n" * 6  # stands in no word
    parts = [lead + b" ".join(words) + (b"  " if words else b" ") for words in texts]
    run = b"\n\n" + b"".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    # Windows of eight bytes, without those that end in a lead.
    own = np.ones(len(run) - 7, bool)
    leads = ((np.cumsum(sizes) - sizes)[:, None] + np.arange(-5, 1)).ravel()
    own[leads[leads >= 0]] = False
    keys = np.ndarray(len(own), "<u8", run, 0, 1)[own]
    keys >>= np.uint64(8)
    return keys, sizes - len(lead)


def table_bits(distinct: int) -> tuple[int, ...]:
    """Bits of the tables for a number of grams: four slots for each, as far as ``ORDERS`` goes."""
    return tuple(min(bits, max(LEAST_BITS, (4 * distinct).bit_length())) for _, bits in ORDERS)


def regions(keys: np.ndarray) -> np.ndarray:
    return (mix(keys << np.uint64(16) >> np.uint64(40)) >> np.uint64(64 - REGION_BITS)).astype(np.int64)


class Spelling:
    """The bytes of some grams and their contexts."""

    def __init__(self, keys: np.ndarray, bits: Sequence[int]):
        self.data = (keys >> np.uint64(48)).astype(np.int64)
        self.bits = bits
        six = keys & np.uint64((1 << 48) - 1)
        self.contexts = [
            mix((six >> np.uint64(48 - 8 * order)) + np.uint64(order << 56)) for order, _ in ORDERS]
        self.begin = [int(x) for x in np.cumsum([0, *(1 << b for b in bits[:-1])])]
        region = regions(keys)
        for k in range(SHARED, len(ORDERS)):
            self.begin[k] = self.begin[k] + (region << (bits[k] - REGION_BITS))

    def bit(self, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every byte's bit ``b``: the bits before it, its value, its slot in every table."""
        node = (1 << b) | (self.data >> (8 - b))
        slots = np.empty((len(ORDERS), len(node)), np.int64)
        mixed = node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k, bits in enumerate(self.bits):
            hashed = self.contexts[k] + mixed
            hashed >>= np.uint64(64 - bits + REGION_BITS * (k >= SHARED))
            np.add(hashed.view(np.int64), self.begin[k], out=slots[k])
        return node, (self.data >> (7 - b)) & 1, slots


def gates(b: int, x: np.ndarray) -> np.ndarray:
    """Bit and number of the longest context that says anything."""
    gate = np.full(x.shape[1], b * (len(ORDERS) + 1))
    for k, said in enumerate(x != 0):
        np.copyto(gate, b * (len(ORDERS) + 1) + k + 1, where=said)
    return gate


def logits(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + np.float32(0.4)) / (zeros + np.float32(0.4)))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -12, 12)))


def refined_at(node: np.ndarray, x: np.ndarray) -> np.ndarray:
    return node * STEPS + np.clip(np.rint(x * 2), -16, 16).astype(np.int64) + 16


def _add(spelling: Spelling, times: np.ndarray, counts: np.ndarray) -> None:
    """Adds to the counts of zeros and ones, which take turns in ``counts``."""
    times = np.broadcast_to(times, (len(ORDERS), len(times))).ravel()
    for b in range(8):
        _, value, slots = spelling.bit(b)
        np.add.at(counts, (2 * slots + value).ravel(), times)


def _step(
    spelling: Spelling, times: np.ndarray, counts: np.ndarray, weights: np.ndarray,
    table: np.ndarray, spread: np.ndarray,
) -> None:
    """One online step per bit; ``counts`` has a pair of halves in every number, ``spread`` the
    curvature seen so far, by gate."""
    orders = len(ORDERS)
    times = times.astype(np.float32)
    for b in range(8):
        node, value, slots = spelling.bit(b)
        pairs = counts[slots].view(np.float16).astype(np.float32).reshape(*slots.shape, 2)
        # Without the occurrence itself.
        x = logits(
            np.maximum(pairs[:, :, 0] - (1 - value).astype(np.float32), 0),
            np.maximum(pairs[:, :, 1] - value.astype(np.float32), 0))
        gate = gates(b, x)
        mixed = np.einsum("kn,kn->n", weights.T[:, gate], x)
        error = value - squash(mixed)
        size = np.abs(error)
        bent = x * (times * np.maximum(size * (1 - size), size * size))
        pulled = x * (times * error)
        low = b * (orders + 1)
        for k in np.flatnonzero(np.bincount(gate - low, minlength=orders + 1)) + low:
            of = np.flatnonzero(gate == k)
            spread[k] += bent[:, of] @ x[:, of].T
            weights[k] += np.linalg.solve(spread[k], pulled[:, of].sum(axis=1))
        table += np.bincount(
            2 * refined_at(node, mixed) + value, times, table.size).reshape(table.shape)


def _start() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, refinement and curvature before anything is learned."""
    return np.full((GATES, len(ORDERS)), 0.3), np.zeros((256 * STEPS, 2)), np.tile(
        10.0 * np.eye(len(ORDERS)), (GATES, 1, 1))


def halves(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Pairs of counts as two halves in a number. They hold 11 bits; a count beyond their range
    shrinks together with the other one."""
    shrink = np.minimum(60_000 / np.maximum(np.maximum(zeros, ones), 1), 1)
    pairs = np.empty((len(zeros), 2), np.float16)
    pairs[:, 0], pairs[:, 1] = zeros * shrink, ones * shrink
    return pairs.view(np.uint32).ravel()


def _first_words(words: Sequence[bytes], bits: Sequence[int]) -> tuple[Spelling, np.ndarray]:
    """The bytes of words, each as the first of a text, with the blank behind it; where they begin."""
    keys, sizes = grams([[w] if w else [] for w in words])
    begin = np.cumsum(sizes) - sizes
    # The end of the text is no part of a word.
    kept = np.ones(len(keys), bool)
    kept[(begin + sizes - 1)[sizes > 1]] = False
    return Spelling(keys[kept], bits), begin - np.cumsum(sizes > 1) + (sizes > 1)


def count_contexts(words: list[bytes], zeros: np.ndarray, ones: np.ndarray) -> None:
    """Counts of the largest tables, from words as first words of texts."""
    spelling, _ = _first_words(words, FULL_BITS)
    counts = np.zeros(2 * SLOTS)
    _add(spelling, np.ones(len(spelling.data)), counts)
    zeros += counts[::2]
    ones += counts[1::2]


def learn(
    words: list[bytes], zeros: np.ndarray, ones: np.ndarray, weights: np.ndarray,
    table: np.ndarray,
) -> None:
    """One online step per bit over some words; updates ``weights`` and ``table``."""
    spelling, _ = _first_words(words, FULL_BITS)
    _step(spelling, np.ones(len(spelling.data)), halves(zeros, ones), weights, table, _start()[2])


class Predictor:
    """What is learned, ready to score grams."""

    def __init__(self, model: dict):
        self.bits = model.get("bits", FULL_BITS)
        self.logits = model["logits"].astype(np.float32)
        self.weights = np.ascontiguousarray(model["weights"].T, np.float32)
        # Half the mixed probability, half that seen where the mix said so.
        seen = model["table"].sum(axis=1) + 4
        self.share = (0.5 + 2 / seen).astype(np.float32)
        self.other = (model["table"][:, 1] / 2 / seen).astype(np.float32)

    def of(self, spelling: Spelling) -> np.ndarray:
        """log10 probability of every byte."""
        product = np.ones(len(spelling.data))
        for b in range(8):
            node, value, slots = spelling.bit(b)
            x = self.logits[slots]
            mixed = np.einsum("kn,kn->n", self.weights[:, gates(b, x)], x)
            at = refined_at(node, mixed)
            p = squash(mixed) * self.share[at] + self.other[at]
            product *= np.where(value == 1, p, 1 - p)
        return np.log10(product)


def spell(words: list[bytes], model: dict) -> np.ndarray:
    """log10 probability of each word and its end as the first of a text."""
    predictor = Predictor(model)
    spelling, begin = _first_words(words, predictor.bits)
    return np.add.reduceat(predictor.of(spelling), begin)


class Memo:
    """Scores of grams. Each has two places; where both are taken it gets the second one, so that
    memory stays bounded and frequent grams stay."""

    def __init__(self, model: dict):
        self.predictor = Predictor(model)
        # No gram has this bit.
        self.keys = np.full(1 << MEMO_BITS, FREE, np.uint64)
        self.values = np.zeros(1 << MEMO_BITS)

    @staticmethod
    def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix(keys)
        return ((mixed >> np.uint64(64 - MEMO_BITS)).view(np.int64),
                (mixed & np.uint64((1 << MEMO_BITS) - 1)).view(np.int64))

    def _put(self, places: np.ndarray, keys: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Which of the keys got their places, no two the same one."""
        self.keys[places] = keys
        held = self.keys[places] == keys
        self.values[places[held]] = scores[held]
        return held

    def of(self, keys: np.ndarray) -> np.ndarray:
        found = np.empty(len(keys))
        missing = [np.empty(0, np.int64)]
        for k in range(0, len(keys), 1 << 15):
            some = keys[k:k + (1 << 15)]
            first, second = self._places(some)
            found[k:k + (1 << 15)] = self.values[first]
            others = np.flatnonzero(self.keys[first] != some)
            second = second[others]
            found[k + others] = self.values[second]
            missing.append(k + others[self.keys[second] != some[others]])
        at = np.concatenate(missing)
        if len(at):
            new, inverse = np.unique(keys[at], return_inverse=True)
            scores = np.concatenate([
                self.predictor.of(Spelling(new[k:k + SCORED_AT_ONCE], self.predictor.bits))
                for k in range(0, len(new), SCORED_AT_ONCE)])
            found[at] = scores[inverse]
            first, second = self._places(new)
            free = np.flatnonzero(self.keys[first] == FREE)
            left = np.ones(len(new), bool)
            left[free] = ~self._put(first[free], new[free], scores[free])
            self._put(second[left], new[left], scores[left])
        return found


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, count) over all texts; ``count`` is of those with ``trains`` only."""
    def run(batches):
        seen: Counter = Counter()

        def flush():
            words, counts = list(seen), list(seen.values())
            seen.clear()
            for start in range(0, len(words), 1 << 16):
                yield pa.RecordBatch.from_arrays([
                    pa.array(words[start:start + (1 << 16)], pa.binary()).cast(pa.string()),
                    pa.array(counts[start:start + (1 << 16)], pa.int64())], ["word", "count"])

        for piece, texts in pieces(batches):
            for text, trains in zip(texts, piece.column("trains").to_pylist()):
                words = text.lower().split() if text else []
                if trains:
                    seen.update(words)
                else:
                    for word in words:
                        seen.setdefault(word, 0)
            if len(seen) > 500_000:
                yield from flush()
        yield from flush()

    return docs.select("text", "trains").mapInArrow(
        run, "word string, count long"
    ).groupBy("word").agg(F.sum("count").alias("count"))


def gram_counts(texts: DataFrame) -> DataFrame:
    """(region, gram, count) over all bytes of the column ``text``; regions stay together."""
    def run(batches):
        kept, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        waiting: list[np.ndarray] = []

        def merge():
            nonlocal kept, counts
            keys = np.concatenate(waiting)
            waiting.clear()
            keys.sort()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            times, keys = np.diff(np.append(starts, len(keys))), keys[starts]
            at = np.searchsorted(kept, keys)
            known = np.zeros(len(keys), bool)
            inside = at < len(kept)
            known[inside] = kept[at[inside]] == keys[inside]
            counts[at[known]] += times[known]
            kept = np.insert(kept, at[~known], keys[~known])
            counts = np.insert(counts, at[~known], times[~known])

        def flush():
            nonlocal kept, counts
            for start in range(0, len(kept), 1 << 16):
                some = kept[start:start + (1 << 16)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(regions(some).astype(np.int32)), pa.array(some.view(np.int64)),
                    pa.array(counts[start:start + (1 << 16)])], ["region", "gram", "count"])
            kept, counts = kept[:0], counts[:0]

        for _, values in pieces(batches):
            waiting.append(grams([t.lower().split() if t else [] for t in values])[0])
            if sum(map(len, waiting)) > SORTED_BYTES:
                merge()
                if len(kept) > HELD_GRAMS:
                    yield from flush()
        if waiting:
            merge()
        yield from flush()

    return texts.select("text").mapInArrow(run, "region int, gram long, count long").repartition(
        "region").groupBy("region", "gram").agg(F.sum("count").alias("count"))


def _fit(counted: DataFrame) -> dict:
    """Context counts, weights and refinement, from all grams as often as they occur."""
    spark = counted.sparkSession
    distinct = counted.count()
    bits = table_bits(distinct)
    size = sum(1 << b for b in bits)

    def count(batches):
        counts = np.zeros(2 * size)
        for batch in batches:
            keys = batch.column("gram").to_numpy().view(np.uint64)
            times = batch.column("count").to_numpy().astype(float)
            for k in range(0, len(keys), SCORED_AT_ONCE):
                _add(Spelling(keys[k:k + SCORED_AT_ONCE], bits), times[k:k + SCORED_AT_ONCE], counts)
        used = np.flatnonzero(counts[::2] + counts[1::2])
        for k in range(0, len(used), 1 << 16):
            some = used[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(counts[2 * some]), pa.array(counts[2 * some + 1])],
                ["slot", "zeros", "ones"])

    # At most as many rows as the tables have slots.
    sums = counted.mapInArrow(count, "slot int, zeros double, ones double").groupBy("slot").agg(
        F.sum("zeros").cast("float").alias("zeros"), F.sum("ones").cast("float").alias("ones")).toArrow()
    zeros, ones = np.zeros(size, np.float32), np.zeros(size, np.float32)
    for part in sums.to_batches():
        slot = part.column("slot").to_numpy()
        zeros[slot], ones[slot] = part.column("zeros").to_numpy(), part.column("ones").to_numpy()
    del sums
    known = logits(zeros, ones).astype(np.float16)
    sent = spark.sparkContext.broadcast(halves(zeros, ones))
    del zeros, ones

    def teach(table: pa.Table) -> pa.Table:
        keys = table.column("gram").to_numpy().view(np.uint64)
        times = table.column("count").to_numpy().astype(float)
        order = np.argsort(mix(keys))
        weights, seen, spread = _start()
        for k in range(0, len(keys), GRAMS_AT_ONCE):
            some = order[k:k + GRAMS_AT_ONCE]
            _step(Spelling(keys[some], bits), times[some], sent.value, weights, seen, spread)
        values = np.concatenate([
            (spread @ weights[:, :, None]).ravel(), spread.ravel(), seen.ravel()])
        used = np.flatnonzero(values)
        return pa.table({"at": pa.array(used), "value": pa.array(values[used])})

    groups = -(-distinct // GROUP_GRAMS)
    # As many rows as weights, their curvatures and refinements at most.
    learned = counted.groupBy(F.pmod(F.xxhash64("gram"), F.lit(max(groups, 1))).alias("part")).applyInArrow(
        teach, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    sent.destroy()
    weights, table, spread = _start()
    cut = weights.size
    values = np.zeros(cut + spread.size + table.size)
    values[learned.column("at").to_numpy()] = learned.column("value").to_numpy()
    if distinct:
        weights = np.linalg.solve(
            values[cut:cut + spread.size].reshape(spread.shape),
            values[:cut].reshape(GATES, -1, 1))[:, :, 0]
    return {
        "bits": bits, "logits": known, "weights": weights,
        "table": values[cut + spread.size:].reshape(table.shape),
    }


def _found(values: list[bytes | None], at: dict[bytes, int]):
    """The words of some texts, by text and in a row, words per text, text of each word, its number or -1."""
    split = [t.lower().split() if t else [] for t in values]
    flat = [w for words in split for w in words]
    sizes = np.array([len(words) for words in split], np.int64)
    return split, flat, sizes, np.repeat(np.arange(len(split)), sizes), np.fromiter(
        map(at.get, flat, repeat(-1)), np.int64, len(flat))


def score_texts(
    docs: DataFrame, trains: Column, id_column: str = "doc_id", text: str = "text",
    top_words: int = TOP_WORDS,
) -> DataFrame:
    """One row per document: id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` (log10 probabilities) and ``bits_per_byte``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.col(id_column).alias("id"), F.coalesce(trains, F.lit(False)).alias("trains"),
        F.col(text).alias("text"))
    vocabulary = stored(word_counts(texts), "vocabulary")
    ends = texts.filter("trains").count()
    words, distinct = vocabulary.agg(
        F.coalesce(F.sum("count"), F.lit(0)), F.count_if(F.col("count") > 0)).first()
    n, v = words + ends, distinct + (ends > 0)
    model = spark.sparkContext.broadcast(
        _fit(stored(gram_counts(texts.filter("trains")), "grams")))

    def base(count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (n + v + 1))

    top = vocabulary.orderBy(F.desc("count"), "word").limit(top_words).toArrow()
    counts = top.column("count").to_numpy()
    frequent = spark.sparkContext.broadcast((
        top.column("word").cast(pa.binary()).to_pylist(),
        np.append(counts > 0, False).astype(float), np.append(base(counts), 0)))
    end_base = float(base(np.array([ends]))[0])

    def look_up(batches):
        names, known, bases = frequent.value
        at = {w: k for k, w in enumerate(names)}
        memo = Memo(model.value)
        for piece, values in pieces(batches):
            split, flat, sizes, of, found = _found(values, at)
            rest = np.flatnonzero(found < 0)
            offsets = np.searchsorted(rest, np.concatenate([[0], np.cumsum(sizes)]))
            keys, lengths = grams(split)

            def total(values):
                return np.bincount(of, values, len(sizes))

            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array(sizes + 1),
                pa.array(total(known[found]).astype(np.int64)),
                pa.array(total(bases[found]) + end_base),
                pa.array(np.add.reduceat(memo.of(keys), np.cumsum(lengths) - lengths)),
                pa.array([len(t) if t else 0 for t in values], pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(offsets.astype(np.int32)),
                    pa.array([flat[k] for k in rest], pa.binary()).cast(pa.string())),
            ], ["id", "n_tokens", "n_known", "base", "score", "bytes", "rest"])

    id_type = texts.schema["id"].dataType.simpleString()
    partial = stored(texts.select("id", "text").mapInArrow(
        look_up, f"id {id_type}, n_tokens long, n_known long, base double, score double, "
        "bytes long, rest array<string>",
    ).withColumn("uid", F.monotonically_increasing_id()), "partial")
    rare = partial.select("uid", F.explode("rest").alias("word")).join(vocabulary, "word").groupBy("uid").agg(
        F.count_if(F.col("count") > 0).alias("r_known"),
        F.sum(F.log10((F.col("count") + 1) / F.lit(n + v + 1))).alias("r_base"))

    def with_rare(column: str) -> Column:
        return F.col(column) + F.coalesce(F.col({"n_known": "r_known", "base": "r_base"}[column]), F.lit(0))

    return partial.drop("rest").join(rare, "uid", "left").select(
        F.col("id").alias(id_column), "n_tokens",
        (with_rare("n_known") + F.lit(int(ends > 0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), with_rare("base").alias("base_score"), "score",
        (-F.col("score") * float(np.log2(10)) / F.greatest(F.col("bytes"), F.lit(1))).alias("bits_per_byte"))
