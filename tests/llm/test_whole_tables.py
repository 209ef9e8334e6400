"""The registered queries over whole small tables, against brute force, SQL or held-out rows."""

import collections
import hashlib
import math
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from lading.llm import chunks, ledger, templates
from lading.llm.queries import ORACLES, QUERIES, tokenizer_path
from lading.llm.words import Hashes

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def _run(spark, name):
    return QUERIES[name](spark, SF).collect()


def _words(row):
    return (row.text or "").encode().split()


def _remainder(number, divisor):
    return zlib.crc32(str(number).encode()) % divisor


def test_mixing(spark, docs):
    rows = _run(spark, "op1_source_mixing")
    taken, target, total = collections.Counter(), {}, 0
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == len(_words(docs[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
        target[source], total = r.target, total + r.size
    assert len(rows) == len(docs) and sum(target.values()) == pytest.approx(1.5 * total)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    assert sorted(rows) == sorted(_run(spark, "op1_source_mixing"))


def test_bpe(spark, docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    rows = _run(spark, "op2_bpe")
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r.doc_id].text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_near_duplicates(spark, docs):
    sets = {}
    for i, row in docs.items():
        words = [w.lower() for w in _words(row)]
        k = min(2, len(words))
        sets[i] = {tuple(words[j:j + k]) for j in range(len(words) - k + 1)} if words else set()
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in _run(spark, "op3_hyperminhash")}
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def test_languages(spark, docs):
    rows = _run(spark, "op4_kneser_ney")
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (_remainder(r.doc_id, 4) == 2) for r in rows)
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.97 * len(held)


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op5_quality_classifier"](spark, sf).collect()}
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()
              if _remainder(r.doc_id, 5) == 0]
    assert all(r.held_out == (_remainder(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.3)
               for r in rows.values())
    assert sum(rows[r.doc_id].predicted == r.quality for r in labels) >= 0.94 * len(labels)


def test_neighbours(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r.vec_id for r in table])
    vectors = np.array([r.embedding for r in table], float)
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    rows = sorted(_run(spark, "op6_block_matrix_neighbours"))
    for k in np.flatnonzero(ids % 50 == 0):
        score = (vectors * vectors[k]).sum(axis=1) / (norm * norm[k])
        score[k] = -9
        best = np.lexsort((ids, -score))[:5]
        assert [(r.rank, r.vec_id) for r in rows if r.query_id == ids[k]] == [
            (n + 1, ids[b]) for n, b in enumerate(best)]


def test_scores(spark, docs):
    counts, ends = collections.Counter(), 0
    for i, row in docs.items():
        if _remainder(i, 7) != 2:
            counts.update(w.lower() for w in _words(row))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    rows = _run(spark, "op7_logistic_mixing")
    assert len(rows) == len(docs)
    for r in rows:
        words = [w.lower() for w in _words(docs[r.doc_id])]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10(
            (ends + 1) / (n + v + 1))
        assert (r.n_tokens, r.train_tokens) == (len(words) + 1, n)
        assert r.n_known == 1 + sum(counts[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base) and r.score < 0


def test_repeated_passages(spark):
    clean = [" ".join(f"c{d}x{k}" for k in range(200)) for d in range(4)]
    passage = " ".join(f"p{k}" for k in range(70))
    texts = [clean[0] + " " + passage, passage + "\n" + clean[1], clean[2],
             "lead " + passage + " tail", clean[3] + "\nof the and a of\n" + clean[3]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    runs = chunks.repeated_runs(table).collect()
    assert {(r.id, r.first_id) for r in runs} == {(1, 0), (3, 0), (4, 4)}
    kept = {r.doc_id: r.text for r in chunks.substring_dedup(table).collect()}
    assert kept[0] == texts[0] and kept[2] == texts[2]
    assert clean[1] in kept[1] and len(kept[1].split()) < 230
    assert kept[3].startswith("lead") and kept[3].endswith("tail") and len(kept[3].split()) < 35
    for a, b in ((0, 1), (0, 3), (1, 3)):
        x, y = ({tuple(t.split()[k:k + 51]) for k in range(len(t.split()) - 50)}
                for t in (kept[a], kept[b]))
        assert not x & y


def test_phrases_seen_apart_are_no_passage(spark):
    words = [f"w{k}" for k in range(60)]
    starts = chunks.chunk_starts(Hashes().of([w.encode() for w in words])).tolist()
    # Each chunk also stands in a short document of its own, between rims that keep its limits.
    texts = [" ".join(words[max(0, a - 5):b + 3]) for a, b in zip(starts, starts[1:])]
    texts = [t for t in texts if len(t.split()) < chunks.LEAST_WORDS] + [" ".join(words)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert chunks.repeated_runs(table).collect() == []
    assert sorted(r.text for r in chunks.substring_dedup(table).collect()) == sorted(texts)


def test_repeated_words_are_passages(spark):
    units = ["ha", "na bo", "la di da", "a a b", "to to to to the", "x x x y x x x x z"]
    texts = []
    for k, unit in enumerate(units):
        for lead, times in ((0, 300), (9, 200), (25, 251)):
            clean = [f"c{k}n{lead}x{j}" for j in range(40)]
            # Shifted, so that the period does not begin alike in every text.
            passage = (unit.split() * times)[lead % 4:]
            texts.append(" ".join(clean[:lead] + passage + clean[lead:]))
    for text in texts:
        starts = chunks.chunk_starts(Hashes().of(text.encode().split()))
        assert np.diff(np.append(starts, len(text.split()))).max() <= chunks.LONGEST
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.doc_id: r.text.split() for r in chunks.substring_dedup(table).collect()}
    seen = collections.Counter(
        w for t in kept.values() for w in {tuple(t[k:k + 51]) for k in range(len(t) - 50)})
    assert set(seen.values()) <= {1}
    for i, words in kept.items():
        assert [w for w in words if w[:1] == "c"] == [w for w in texts[i].split() if w[:1] == "c"]


def test_falling_values_break():
    order = np.arange(2000, dtype=np.uint64)
    falling = order[np.argsort(chunks.mix(order))[::-1]]
    old, chunks.gear = chunks.gear, lambda hashes, words=2: chunks.mix(hashes)
    try:
        starts = chunks.chunk_starts(falling)
    finally:
        chunks.gear = old
    assert np.diff(np.append(starts, 2000)).max() <= chunks.LONGEST


@pytest.mark.parametrize("seed", range(20))
def test_windows_cover_all_long_stretches(seed):
    rng = np.random.default_rng(seed)
    limits = np.concatenate([[0], np.cumsum(rng.integers(1, 12, rng.integers(1, 20)))])
    first, after = chunks.windows(limits[:-1], limits[-1], 20)
    found = set(zip(first.tolist(), after.tolist()))
    assert len(found) == len(first)
    for a in range(len(limits)):
        for b in range(a + 1, len(limits)):
            covered = set().union(*(range(x, y) for x, y in found if a <= x and y <= b))
            assert covered == (set(range(a, b)) if limits[b] - limits[a] >= 20 else set())


def test_urls(spark):
    rows = _run(spark, "op9_url_templates")
    urls = {r.page_id: r.url or "" for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    rules = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
    for r in rows:
        rest = urls[r.page_id].partition("://")[2]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host):])[0]
        fits = [(len(h + p), h + p, v) for v, h, p in rules
                if (r.host == h or r.host.endswith("." + h)) and path.startswith(p)]
        assert (r.host, r.path) == (host.lower(), path)
        assert r.rule == (max(fits)[1] if fits else None)
        assert not fits or r.verdict == max(fits)[2]


def test_templates_of_bad_labels_are_blocked(spark):
    urls = [(k, f"http://h.example/spam/{k}.html", True) for k in range(20)] + [
        (100 + k, f"http://h.example/news/{k}", False) for k in range(20)] + [
        (200, "http://h.example/spam/999.html", None), (201, "http://h.example/news/999", None),
        (202, "http://other.example/spam/1.html", None), (203, None, None), (204, "no host", None)]
    table = spark.createDataFrame(urls, "page_id long, url string, bad boolean")
    from pyspark.sql import functions as F
    parsed = table.select(
        "page_id", "bad", templates.host_of(F.col("url")).alias("host"),
        templates._segments(templates.path_of(F.col("url"))).alias("segments"))
    leaves = parsed.withColumn("leaf", F.concat_ws("/", "host", "segments"))
    purity = templates.purities(leaves.select("leaf", "host", "segments", "bad"))
    got = {r.page_id: r.rejected for r in leaves.join(purity, "leaf").collect()}
    assert got[200] and not any(got[k] for k in (201, 202, 203, 204))


def test_rules_against_sql(spark):
    frame = QUERIES["op10_quality_rules"](spark, SF)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    result = con.execute(ORACLES["op10_quality_rules"])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert sorted(tuple(r[c] for c in names) for r in frame.collect()) == sorted(result.fetchall())


def test_ablations(spark, docs):
    entries = ledger.ledger(ledger.measure(spark.read.parquet(f"{SF}/documents.parquet"))).cache()
    masks = [r.failed for r in entries.collect()]
    for r in ledger.ablations(entries, ledger.STANDARD).collect():
        bit = 1 << next(x.bit for x in ledger.standard_rules() if x.name == r.rule)
        assert (r.failed, r.only) == (sum(bool(m & bit) for m in masks), masks.count(bit))
        assert r.kept == masks.count(0) and r.kept_without == r.kept + r.only


def test_pipeline(spark, docs):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "near_dedup", "substring_dedup", "source_mixing", "bpe"]
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.round_trip for r in rows)
    assert {r.doc_id for r in rows} <= set(docs)
    assert all(r.n_chars == len(r.text) and len(r.token_ids) == 4 * r.n_tokens for r in rows)
