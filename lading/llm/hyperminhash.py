"""Near-duplicate documents by HyperMinHash sketches, banding and verification on full sets.

A document is the set of its distinct word shingles (A-Z lower-cased), as 64-bit hashes. Its
sketch has 256 registers, and for the documents of step 4 another one has 1,024: the smallest hash of
a bucket, kept as its count of leading zeros and ten bits of mantissa. Steps, all of them distributed:

1. equal sets are one class, of which only the smallest id goes on;
2. bands of five registers (empty ones borrow from others along fixed permutations) give buckets;
   the members of a bucket are tried with its smallest id, a star and not all pairs: first with the
   smallest such leader of all their buckets, then with the others that are still in a different
   component;
3. pairs that cannot be similar enough by size or number of differing registers, or whose
   collision-corrected estimate is five standard deviations too low, are dropped; all others are
   compared on their full sets, and links that hold give components;
4. in buckets that still hold several components the members outside the largest one are compared
   with all others of other components, in blocks by sketch; what those leave is compared on full
   sets as well, and the components are final.

A pair of similarity 0.8 shares no band with a probability of about 2e-9, more similar pairs with
a smaller one. No candidate is dropped otherwise.

Defined results: null, empty and blank texts have no shingles and no links. A text with fewer
words than a shingle has is one shingle. Ties go to the smaller id. Rows that repeat an id are
judged each by its text; rows with a null id are in no component (null) and kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import stored
from .components import components
from .joins import join_hot, sized
from .words import Hashes, mix, pieces

BUCKET_BITS = 8
FINE_BITS = 10
FINE = 1 << FINE_BITS
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND_ROWS = 5
BANDS = BUCKETS // BAND_ROWS
BLOCK = 512
_ORDERS = np.random.default_rng(1).permuted(
    np.tile(np.arange(BUCKETS), (BUCKETS, 1)), axis=1
)
_FACTORS = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)).reshape(BANDS, BAND_ROWS) | np.uint64(1)


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a document, given its words' hashes."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    windows = np.full(len(hashes) - width + 1, width, np.uint64)
    for k in range(width):
        windows = mix(windows * np.uint64(0x9E3779B97F4A7C15) + hashes[k:len(hashes) - width + 1 + k])
    return np.unique(windows)


def sketch(shingles: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """Registers of 16 bits: leading zeros and mantissa of a bucket's smallest hash, 0: empty."""
    buckets, rest = np.arange(1 << bits, dtype=np.uint64), np.uint64(64 - bits)
    at = np.searchsorted(shingles, buckets << rest)
    first = shingles[np.minimum(at, len(shingles) - 1)]
    held = (at < len(shingles)) & (first >> rest == buckets)
    low = first & np.uint64((1 << (64 - bits)) - 1)
    fraction, exponent = np.frexp(low.astype(np.float64))
    zeros = np.clip(64 - bits - exponent, 0, 57)
    mantissa = np.clip((fraction * 2 - 1) * (1 << MANTISSA_BITS), 0, (1 << MANTISSA_BITS) - 1)
    value = (zeros << MANTISSA_BITS) + mantissa.astype(np.int64) + 1
    return np.where(held, value, 0).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of registers; an empty register takes another's value."""
    empty = np.flatnonzero(registers == 0)
    if len(empty):
        orders = _ORDERS[empty]
        first = (registers[orders] != 0).argmax(axis=1)
        registers = registers.copy()
        registers[empty] = registers[orders[np.arange(len(empty)), first]]
    rows = registers[:BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS).astype(np.uint64)
    return mix((mix(rows + _FACTORS) * _FACTORS).sum(axis=1) + np.arange(BANDS, dtype=np.uint64))


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated similarity of rows of sketches, less the expected chance matches, and its bases."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    same = ((a == b) & (a != 0)).sum(axis=1)
    ratio = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    chance = 0.1699 * a.shape[1] * 2.0 ** -MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(same - chance, 0) / np.maximum(used, 1), used


def _plausible(a, b, n, m, similarity: float) -> np.ndarray:
    """Whether the sets can be similar enough, by their sizes and sketches.

    Every register that differs is owed to a shingle that only one of the sets has, and of those
    similar sets have at most (1 - s) / (1 + s) of the sum of their sizes; for small sets this
    says more than the estimate.
    """
    near, used = estimate(a, b, n, m)
    differ = used - ((a == b) & (a != 0)).sum(axis=1)
    spread = np.sqrt(similarity * (1 - similarity) / np.maximum(used, 1))
    return (
        (near >= similarity - 5 * spread)
        & (differ <= (1 - similarity) / (1 + similarity) * (n + m) + 1e-6)
        & (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6))


def _sets(batches, width: int):
    memo = Hashes()
    for piece, texts in pieces(batches):
        split = [t.lower().split() if t else [] for t in texts]
        hashes = memo.of([w for words in split for w in words])
        ends = np.cumsum([len(words) for words in split])
        yield piece, [
            shingle_set(hashes[end - len(words):end], width) for end, words in zip(ends, split)
        ]


def _digests(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([
        hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
        pa.binary())


def _sketches(sets: list[np.ndarray], bits: int) -> pa.Array:
    return pa.array([sketch(s, bits).tobytes() if len(s) else None for s in sets], pa.binary())


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """(id, row, n, digest, registers) of every document; the digest names its whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays([
                piece.column(0), piece.column(1), pa.array([len(s) for s in sets], pa.int64()),
                _digests(sets), _sketches(sets, BUCKET_BITS)],
                ["id", "row", "n", "digest", "registers"])

    return docs.select("id", F.xxhash64("text").alias("row"), "text").mapInArrow(
        run, "id long, row long, n long, digest binary, registers binary")


def _fine(docs: DataFrame, classes: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, n, fine) of those classes whose smallest id is among ``ids``. Only they get the wide sketch."""
    def run(batches):
        for piece, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays([
                piece.column(0), pa.array([len(s) for s in sets], pa.int64()), _digests(sets),
                _sketches(sets, FINE_BITS)], ["id", "n", "digest", "fine"])

    made = docs.select("id", "text").join(ids, "id", "left_semi").mapInArrow(
        run, "id long, n long, digest binary, fine binary")
    leads = classes.select(F.col("lead").alias("id"), "digest").join(ids, "id", "left_semi")
    return stored(made.join(leads, ["id", "digest"], "left_semi").select("id", "n", "fine"), "fine")


def _bands(representatives: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = [
                    band_keys(np.frombuffer(r, np.uint16)) for r in batch.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate(keys).view(np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)),
                ], ["band", "id"])

    return representatives.select("id", "registers").mapInArrow(run, "band long, id long")


def _slices(batches, rows: int = 1000):
    """Smaller pieces of Arrow batches, so that what is made of one stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _screened(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The pairs that their sketches leave possible."""
    def side(name):
        return sketches.select(
            F.col("id").alias(name), F.col("n").alias(f"n_{name}"),
            F.col("registers").alias(f"r_{name}"))

    def run(batches):
        for batch in _slices(batches):
            if batch.num_rows:
                a, b = (
                    np.frombuffer(b"".join(batch.column(f"r_{s}").to_pylist()), np.uint16)
                    .reshape(-1, BUCKETS) for s in "ab")
                n, m = (batch.column(f"n_{s}").to_numpy() for s in "ab")
                keep = pa.array(_plausible(a, b, n, m, similarity))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return pairs.join(side("b"), "b").join(side("a"), "a").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs whose full sets are similar enough. Sets are made for documents in pairs only."""
    ids = sized(stored(
        pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ids"))

    def make(batches):
        for piece, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["id", "shingles"])

    sets = stored(
        docs.select("id", "text").join(ids, "id", "left_semi")
        .mapInArrow(make, "id long, shingles binary"), "sets")
    hundredths = round(similarity * 100)

    def check(batches):
        for batch in _slices(batches):
            if batch.num_rows:
                keep = []
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= hundredths * (len(x) + len(y) - both))
                keep = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    of_b = sets.withColumnsRenamed({"id": "b", "shingles": "y"})
    of_a = sets.withColumnsRenamed({"id": "a", "shingles": "x"})
    return pairs.join(of_b, "b").join(of_a, "a").mapInArrow(check, "a long, b long").distinct()


def _open_pairs(
    members: DataFrame, labels: DataFrame, sketches: Callable[[DataFrame], DataFrame], similarity: float
) -> DataFrame:
    """Possible pairs between different components inside one bucket, block by block.

    ``members`` are (band, id), ``sketches`` gives (id, n, fine) of some ids. The largest component of a
    bucket is never compared with itself.
    """
    labelled = members.join(labels, "id", "left").select(
        "band", "id", F.coalesce("component", "id").alias("component"))
    sizes = labelled.groupBy("band", "component").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("s"))
    wide = sizes.groupBy("band").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.sum("n").alias("all"), (F.sum("n") - F.max("n")).alias("others"),
        F.bit_xor("s").alias("s"),
    ).filter("others > 0")
    # Buckets of one and the same set of members are looked at once.
    once = wide.groupBy("s", "all", "others").agg(F.min_by(F.struct("band", "main"), "band").alias("b"))
    open_buckets = once.select(
        "b.band", "b.main",
        F.ceil(F.col("all") / BLOCK).cast("int").alias("cols"),
        F.ceil(F.col("others") / BLOCK).cast("int").alias("rows"))
    held = stored(labelled.join(open_buckets, "band"), "open")
    ids = sized(stored(held.select("id").distinct(), "ids"))
    held = held.join(sketches(ids), "id")
    block = F.xxhash64("id").bitwiseAND(F.lit((1 << 40) - 1))
    keep = ("band", "id", "component", "n", "fine")
    left = held.filter("component <> main").select(
        *keep, F.lit(True).alias("outer"), (block % F.col("rows")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("j"))
    right = held.select(
        *keep, F.lit(False).alias("outer"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"),
        (block % F.col("cols")).cast("int").alias("j"))

    def compare(group: pa.Table) -> pa.Table:
        outer = group.column("outer").to_numpy()
        ids, comp, n = (group.column(c).to_numpy() for c in ("id", "component", "n"))
        regs = np.frombuffer(
            b"".join(group.column("fine").to_pylist()), np.uint16).reshape(-1, FINE)
        found = []
        inner = np.flatnonzero(~outer)
        for k in np.flatnonzero(outer):
            other = inner[comp[inner] != comp[k]]
            if len(other):
                mine = np.broadcast_to(regs[k], (len(other), FINE))
                hit = other[_plausible(mine, regs[other], n[k], n[other], similarity)]
                found += [(min(ids[k], ids[o]), max(ids[k], ids[o])) for o in hit]
        found = sorted(set(found))
        return pa.table({
            "a": pa.array([a for a, _ in found], pa.int64()),
            "b": pa.array([b for _, b in found], pa.int64())})

    return left.unionByName(right).groupBy("band", "i", "j").applyInArrow(
        compare, "a long, b long").distinct()


def _one_each(pairs: DataFrame) -> DataFrame:
    """One pair between every two components: the one of its smallest ids."""
    return pairs.groupBy(F.least("c_a", "c_b"), F.greatest("c_a", "c_b")).agg(
        F.min(F.struct("a", "b")).alias("p")).select("p.a", "p.b")


def _apart(pairs: DataFrame, labels: DataFrame, named_too: bool = False) -> DataFrame:
    """The pairs (a, b) that are not yet in one component."""
    def named(side):
        return labels.select(F.col("id").alias(side), F.col("component").alias(f"c_{side}"))

    return pairs.join(named("b"), "b", "left").join(named("a"), "a", "left").filter(
        F.coalesce("c_a", "a") != F.coalesce("c_b", "b")
    ).select("a", "b", *(
        [F.coalesce("c_a", "a").alias("c_a"), F.coalesce("c_b", "b").alias("c_b")]
        if named_too else []))


def near_duplicates(
    docs: DataFrame, width: int = 5, similarity: float = 0.8,
    id_column: str = "doc_id", text: str = "text", with_row: bool = False,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``, ``kept``, and with ``with_row`` a hash
    of its text, ``row``."""
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    signed = stored(signatures(docs, width), "signatures")
    classes = stored(
        signed.filter("n > 0 and id is not null").groupBy("digest")
        .agg(F.min("id").alias("lead"), F.count("*").alias("size")), "classes")
    heads = signed.join(classes, (signed.id == classes.lead) & (signed.digest == classes.digest))
    sketches = stored(heads.select(signed.id, "n", "registers").distinct(), "sketches")

    bands = _bands(sketches)
    buckets = bands.groupBy("band").agg(
        F.min("id").alias("a"), F.max("id").alias("z"), F.count("*").alias("size")
    ).filter("a < z").drop("z")
    members = stored(join_hot(bands, stored(buckets, "buckets"), "band", "size"), "members")
    stars = stored(
        members.filter("id <> a").select("a", F.col("id").alias("b")).distinct(), "stars")
    links = None
    # First every member with its smallest leader; then, between what are still different
    # components, with its other leaders; then with the other members of its buckets. Of the
    # pairs between two components one is tried before the others, which are then often settled.
    for step in ("first", "best star", "stars", "best", "blocks"):
        if step == "first":
            pairs = _screened(stars.groupBy("b").agg(F.min("a").alias("a")), sketches, similarity)
        elif step == "best star":
            held = stored(_screened(_apart(stars, labels), sketches, similarity), "held")
            pairs = _one_each(_apart(held, labels, True))
        elif step == "best":
            held = stored(_open_pairs(
                members.filter("size > 2").select("band", "id"), labels,
                lambda ids: _fine(docs, classes, ids, width), similarity
            ).join(stars, ["a", "b"], "left_anti"), "held")
            pairs = _one_each(_apart(held, labels, True))
        else:
            pairs = _apart(held, labels)
        pairs = stored(pairs, "pairs")
        if links is None or not pairs.isEmpty():
            found = _confirmed(pairs, docs, width, similarity)
            links = stored(found if links is None else links.union(found), "links")
            labels = components(links)

    named = classes.join(labels, classes.lead == labels.id, "left").select(
        "digest", "size", F.coalesce("component", "lead").alias("component"))
    linked = join_hot(
        signed.filter("n > 0 and id is not null").select("id", "row", "n", "digest"), named,
        "digest", "size")
    alone = signed.filter("n = 0 or id is null").select(
        "id", "row", "n", F.col("id").alias("component"))
    return linked.select("id", "row", "n", "component").union(alone).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
        *["row"] * with_row)
