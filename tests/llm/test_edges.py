"""Every operator on odd rows and on none."""

import pytest
from pyspark.sql import functions as F

from lading.llm import (
    bpe, chunks, hyperminhash, kneser_ney, ledger, mixing, mixture, neighbours, quality, stages,
    templates, words,
)
from lading.llm.queries import URL_RULES, remainder, tokenizer_path


def _judged(spark, docs):
    labels = spark.createDataFrame(
        [(4, 1), (5, None), (None, 1), (7, 0), (8, 0), (8, 1)], "doc_id long, quality int")
    measured = quality.with_statistics(docs)
    return quality.scored(measured, quality.fit(measured, labels, "quality", F.lit(True)))


OPERATORS = {
    "mixing": lambda s, d: mixing.mix(d),
    "bpe": lambda s, d: bpe.decode(bpe.encode(d, tokenizer_path()), tokenizer_path()),
    "hyperminhash": lambda s, d: hyperminhash.near_duplicates(d, 2),
    "kneser_ney": lambda s, d: kneser_ney.identify(d, remainder("doc_id", 4) != 2),
    "quality": _judged,
    "mixture": lambda s, d: mixture.score_texts(d, remainder("doc_id", 7) != 2),
    "chunks": lambda s, d: chunks.substring_dedup(d),
    "ledger": lambda s, d: ledger.ledger(ledger.measure(d)),
    "templates": lambda s, d: templates.judge(d, URL_RULES, "doc_id", "text"),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_one_row_per_row(spark, edges, name):
    assert len(OPERATORS[name](spark, edges).collect()) == 11


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_rows(spark, nothing, name):
    assert OPERATORS[name](spark, nothing).collect() == []


def test_groups_of_odd_rows(spark, edges):
    rows = hyperminhash.near_duplicates(edges, 2).collect()
    assert {(r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in rows} == {
        (1, False, 1, True), (2, False, 2, True), (3, False, 3, True), (4, True, 4, True),
        (5, True, 4, False), (6, True, 6, True), (None, True, None, True), (7, True, 7, True),
        (8, True, 8, True), (9, False, 9, True)}


def test_rejected_languages_and_letters(spark, edges):
    rows = {r.doc_id: r for r in kneser_ney.identify(edges, F.lit(True)).collect()}
    assert {k for k, r in rows.items() if r.lang_pred == "und"} == {1, 2, 3, 8, 9}
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert rows[6].lang_pred == "en"


def test_stages_keep_columns(spark, edges):
    mixed = stages.source_mixing(edges)
    assert mixed.columns == edges.columns and stages.substring_dedup(edges).columns == edges.columns
    near = stages.near_dedup(edges)
    assert near.columns == edges.columns
    assert sorted(str(r.doc_id) for r in near.collect()) == sorted(
        map(str, [1, 2, 3, 4, 6, None, 7, 8, 9]))


def test_odd_vectors(spark):
    nan = float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [nan, 1.0]),
        (5, [1.0, None]), (6, [0.0, 2.0]), (None, [1.0, 1.0]), (50, [2.0, 0.0]), (50, [2.0, 0.0]),
        (100, [1.0, 2.0, 3.0]), (7, [float("inf"), 1.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.nearest(table, F.col("id") % 50 == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == [
        (0, 1, 1, 1.0), (0, 2, 50, 1.0), (0, 3, 6, 0.0),
        (50, 1, 0, 1.0), (50, 2, 1, 1.0), (50, 3, 6, 0.0)]
    assert neighbours.nearest(table.filter("vec_id < 0"), F.lit(True)).collect() == []


def test_wide_sketches_of_some_leads_only(spark):
    """Signatures hold no wide sketch; it is made of the asked ids' leading texts alone."""
    texts = {k: " ".join(f"w{k}x{n}" for n in range(40)) for k in range(6)}
    rows = [*texts.items(), (7, texts[3]), (7, "another text of seven words under it")]
    docs = spark.createDataFrame(rows, "id long, text string")
    signed = hyperminhash.signatures(docs, 2)
    assert signed.columns == ["id", "row", "n", "digest", "registers"]
    classes = signed.groupBy("digest").agg(F.min("id").alias("lead"))
    ids = spark.createDataFrame([(2,), (7,)], "id long")
    found = {(r.id, r.n): bytes(r.fine) for r in hyperminhash._fine(docs, classes, ids, 2).collect()}
    memo = words.Hashes()
    assert found == {
        (k, n): hyperminhash.sketch(
            hyperminhash.shingle_set(memo.of([w.encode() for w in text.split()]), 2),
            hyperminhash.FINE_BITS).tobytes()
        for k, n, text in ((2, 39, texts[2]), (7, 6, rows[-1][1]))}
