"""Pieces of the operators against plain code, without Spark."""

import collections
import itertools
import random

import numpy as np
import pytest

from lading.llm import bpe, chunks, hyperminhash, kneser_ney, mixing, mixture, neighbours, quality
from lading.llm.queries import tokenizer_path
from lading.llm.words import Hashes

tokenizers = pytest.importorskip("tokenizers")


def test_bpe_agrees_with_the_library():
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    vocabulary = bpe.load(tokenizer_path())
    encoder = bpe.Encoder(vocabulary)
    rng = random.Random(1)
    signs = "abcdehinorstu   ABCéüñß0129!?.,'\n\t#½²Ⅷ中文😀 　\x1c\x85"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    texts += ["a" * n for n in range(60)] + [" " * n for n in range(40)] + [
        "ab" * 500, "<|endoftext|>", "x<|endoftext|> y<|endoftext|><|endoftext|>", "é" * 300,
        "I'll we've DON'T can't", " \n\n  x\n "]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = bpe.packed_ids(text.encode(), encoder)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert b"".join(vocabulary.labels[i] for i in ids).decode("utf-8", "replace") == \
            library.decode(ids, skip_special_tokens=False)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        common = rng.integers(0, 2 ** 63, int(4000 * share)).astype(np.uint64)
        sets = [np.unique(np.concatenate([
            common, rng.integers(0, 2 ** 63, 4000 - len(common)).astype(np.uint64)]))
            for _ in range(2)]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        a, b = (hyperminhash.sketch(s, hyperminhash.FINE_BITS)[None, :] for s in sets)
        near, _ = hyperminhash.estimate(a, b, np.array([4000]), np.array([4000]))
        assert abs(near[0] - true) < 0.06


def test_small_sets_at_the_limit_share_a_band():
    rng = np.random.default_rng(2)
    for size in (5, 10, 20, 45):
        for _ in range(40):
            base = rng.integers(0, 2 ** 63, size).astype(np.uint64)
            less = base[: -(size // 5)]
            bands = [set(hyperminhash.band_keys(hyperminhash.sketch(np.sort(s))).tolist())
                     for s in (base, less)]
            assert bands[0] & bands[1]


def test_chunks_resist_shifts():
    rng = random.Random(3)
    hashes = Hashes()
    shared = [f"s{rng.random()}".encode() for _ in range(60)]
    found = []
    for lead in (0, 1, 7, 50):
        words = [f"{rng.random()}".encode() for _ in range(lead)] + shared
        h = hashes.of(words)
        starts = chunks.chunk_starts(h)
        assert min(np.diff(starts)[1:], default=9) >= 4
        found.append(set(chunks.digests(h, starts).tolist()))
    assert len(set.intersection(*found)) >= 3


@pytest.mark.parametrize("seed", range(6))
def test_cheapest_flow(seed):
    rng = random.Random(seed)
    supply = {p: rng.randint(1, 3) for p in range(3)}
    members = {0: ("a",), 1: ("b",), 2: ("a", "b")}
    quota = {"a": rng.randint(1, 5), "b": rng.randint(1, 5)}
    flow = mixing.cheapest_flow(supply, members, quota, 2)

    def cost(f):
        given = collections.Counter()
        for (p, _), w in f.items():
            given[p] += w
        return None if any(given[p] > 2 * supply[p] for p in supply) else sum(
            max(0, given[p] - supply[p]) for p in supply)

    best = None
    edges = [(p, s) for p in supply for s in members[p]]
    for amounts in itertools.product(*[range(quota[s] + 1) for _, s in edges]):
        f = dict(zip(edges, amounts))
        taken = collections.Counter()
        for (_, s), w in f.items():
            taken[s] += w
        if any(taken[s] > quota[s] for s in quota) or cost(f) is None:
            continue
        key = (-sum(taken.values()), cost(f))
        best = key if best is None else min(best, key)
    assert (-sum(flow.values()), cost(flow)) == best


def test_targets_are_capped_and_complete():
    want = mixing.targets([("b", 10), ("a", 100), (None, 1000), ("c", 5)])
    sizes = {"b": 10, "a": 100, None: 1000, "c": 5}
    assert all(want[k] <= 2 * sizes[k] + 1e-9 for k in sizes)
    assert abs(sum(want.values()) - 1.5 * 1115) < 1e-6 and want["b"] == 20
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0}


def test_boosting_separates():
    rng = np.random.default_rng(0)
    x = rng.random((600, len(quality.FEATURES)))
    y = ((x[:, 2] > 0.5) ^ (x[:, 5] > 0.3)).astype(float)
    forest = quality.grow(x[:400], y[:400])
    assert ((forest.score(x[400:]) > 0.5) == y[400:]).mean() > 0.95
    assert quality.grow(x[:9], np.ones(9)).score(x[:2]).tolist() == pytest.approx([0.999, 0.999])


def test_character_models_are_distributions():
    models = kneser_ney.fit([["abba baba abab"], ["xyz zyx"]], ["p", "q"])
    ends = models.spell(["ab", "abq", "zz"])
    assert (ends < 0).all() and ends[0, 0] > ends[0, 1] and ends[2, 1] > ends[2, 0]


def test_spelling_probabilities_add_up():
    zeros, ones = np.zeros(mixture.SLOTS), np.zeros(mixture.SLOTS)
    words = [b"abc", b"abd", b"b"]
    mixture.count_contexts(words, zeros, ones)
    weights = np.full((mixture.GATES, len(mixture.ORDERS)), 0.3)
    table = np.zeros((256 * mixture.STEPS, 2))
    mixture.learn(words, zeros, ones, weights, table)
    model = {"logits": mixture.logits(zeros, ones), "weights": weights, "table": table}
    # First bytes: every continuation of one byte is counted once by its own end and the rest.
    total = 0.0
    for first in range(256):
        if first != 32:
            spelled = mixture.spell([bytes([first])], model)[0]
            total += 10 ** spelled
    assert 0 < total < 1
    assert mixture.spell([b"abc"], model)[0] > mixture.spell([b"qzx"], model)[0]


def test_tiles_lose_nothing():
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 16))
    vectors[50:100] = vectors[0]
    ids = np.arange(300)
    q, c, s = neighbours.tile(ids[:20], vectors[:20], ids, vectors, 5)
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    for k in range(20):
        score = (vectors * vectors[k]).sum(axis=1) / (norm * norm[k])
        score[k] = -9
        assert c[q == k].tolist() == np.lexsort((ids, -score))[:5].tolist()
