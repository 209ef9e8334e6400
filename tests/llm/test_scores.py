"""The bit predictors of ``mixture`` run over whole texts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lading.llm import mixture


def _texts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_order_of_words_counts(spark):
    """Each word has its follower in training; the same words in another order are less likely."""
    rng = np.random.default_rng(5)
    pairs = ["ab cd", "ef gh", "ij kl", "mn op", "qr st"]
    texts = [" ".join(pairs[k] for k in rng.integers(0, 5, 60)) for _ in range(40)]
    seen, turned = " ".join(pairs), "cd ab gh ef kl ij op mn st qr"
    docs = _texts(spark, [*texts, seen, turned])
    rows = {r.doc_id: r for r in mixture.score_texts(docs, F.col("doc_id") < 40).collect()}
    assert rows[40].base_score == pytest.approx(rows[41].base_score)
    assert rows[40].score > rows[41].score + 3
    # A known pair costs little more than the choice among five.
    assert rows[40].score > -5 * math.log10(5) - 6 and rows[40].score > rows[40].base_score


def test_every_byte_of_every_text_is_counted(spark):
    texts = ["to be or not to be", None, "", "To be", " \n", "x" * 40, "to be or not to be"]
    split = [t.lower().encode().split() if t else [] for t in texts]
    rows = mixture.gram_counts(_texts(spark, texts).repartition(3)).collect()
    expected = {}
    for words in split:
        run = b"\n" * 6 + b"".join(w + b" " for w in words) + b" "
        for k in range(6, len(run)):
            gram = int.from_bytes(run[k - 6:k + 1], "little")
            expected[gram] = expected.get(gram, 0) + 1
    assert {r.gram: r["count"] for r in rows} == expected and len(rows) == len(expected)
    keys, sizes = mixture.grams(split)
    assert sizes.tolist() == [sum(len(w) + 1 for w in words) + 1 for words in split]
    assert len(keys) == sum(expected.values())


def test_bytes_after_any_context_add_up_to_one(spark):
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 50, 80)) for _ in range(30)]
    model = mixture._fit(mixture.gram_counts(_texts(spark, texts)))
    for before in (b"\n" * 6, b"w1 w2 ", b" w3 w4", b"zzzzzz", bytes(range(250, 256))):
        keys = np.array(
            [int.from_bytes(before + bytes([k]), "little") for k in range(256)], np.uint64)
        scores = mixture.Predictor(model).of(mixture.Spelling(keys, model["bits"]))
        assert (10.0 ** scores).sum() == pytest.approx(1, abs=1e-4)
        # Remembered or not, in any order and number.
        memo, some = mixture.Memo(model), rng.integers(0, 256, 1000)
        assert (memo.of(keys[some]) == scores[some]).all() and (memo.of(keys) == scores).all()


def test_partitions_make_no_difference(spark):
    rng = np.random.default_rng(9)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 300, 120)) for _ in range(60)]
    found = []
    for partitions in (8, 3):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        try:
            rows = mixture.score_texts(
                _texts(spark, texts).repartition(partitions), F.col("doc_id") % 5 != 0).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        found.append({r.doc_id: r.score for r in rows})
    assert found[0] == pytest.approx(found[1], rel=1e-9)
