"""Token files, centroid clusters and the source audit against plain code, and on odd rows."""

import collections
import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lading.llm import clusters, divergence, rans, token_files, words
from lading.llm.queries import END_ID, QUERIES, tokenizer_path
from lading.session import new_run_dir

SF = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


# --- token files


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000, 70_000, 300_001])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n) - 1, 4999).astype(np.uint32)
    table = rans.Table.frombytes(rans.Table(rans.frequencies(np.bincount(ids, minlength=5000))).tobytes())
    segments = list(rans.encode_block(ids, table))
    found = [
        rans.decode_segment(payload, held, lanes, table, k + 1 == len(segments))
        for k, (held, lanes, payload) in enumerate(segments)]
    assert (np.concatenate(found) == ids).all()
    # Any segment by itself, from its checkpoint on.
    held, lanes, payload = segments[-1]
    assert (rans.decode_segment(payload, held, lanes, table, True) == ids[n - held:]).all()
    if n > 100_000:
        assert len(segments) > 1
        share = np.bincount(ids) / n
        entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
        assert sum(len(p) - 8 * lanes for _, _, p in segments) * 8 / n < entropy * 1.01 + 0.1


@pytest.mark.parametrize("counts", [
    [5], [0, 7, 0], [1] * 1000, [10**15, 1, 1], [1] * 400 + [10**9], [10**12] * 3 + [1] * 50_000, [0, 0]])
def test_slots(counts):
    counts = np.array(counts, np.int64)
    slots = rans.frequencies(counts)
    assert ((slots > 0) == (counts > 0)).all()
    assert slots.sum() == ((1 << rans.BITS) if counts.sum() else 0)


def test_only_one_id_and_unknown_ids():
    table = rans.Table(rans.frequencies(np.array([0, 9])))
    (held, lanes, payload), = rans.encode_block(np.ones(1000, np.uint32), table)
    assert (rans.decode_segment(payload, held, lanes, table, True) == 1).all()
    with pytest.raises(ValueError):
        list(rans.encode_block(np.zeros(3, np.uint32), table))


def test_spans_and_damage_of_a_file():
    rng = np.random.default_rng(3)
    docs = [(k if k % 5 else None, rng.integers(0, 900, size)) for k, size in enumerate(
        [0, 3, 700_000, 1, 0, 900_000, 12_000, 5])]
    table = rans.Table(rans.frequencies(np.ones(900, np.int64)))
    writer = token_files.FileWriter(table)
    data = b"".join(part for key, ids in docs for part in writer.add(key, ids.astype(np.uint32)))
    data += b"".join(writer.end())

    def read_at(length, offset):
        return data[offset:offset + length]

    reader = token_files.FileReader(read_at, len(data), table)
    every = np.concatenate([ids for _, ids in docs])
    assert reader.keys == [key for key, _ in docs]
    assert np.diff(reader.limits).tolist() == [len(ids) for _, ids in docs]
    for first, stop in [(0, len(every)), (0, 1), (262_143, 262_145), (1_500_000, 1_600_000), (7, 7)]:
        parts = list(reader.span(first, stop))
        assert (np.concatenate([*parts, []]) == every[first:stop]).all()
    # The end is reached without what comes before its checkpoint.
    seen = []
    late = token_files.FileReader(
        lambda length, offset: seen.append(offset) or read_at(length, offset), len(data), table)
    list(late.span(len(every) - 5, len(every)))
    assert len(seen) == 3 and min(seen) > len(data) // 2
    for wrong in (100, len(data) // 2, len(data) - 30, len(data) - 1):
        harmed = bytearray(data)
        harmed[wrong] ^= 1
        with pytest.raises(ValueError):
            bad = token_files.FileReader(
                lambda length, offset: bytes(harmed[offset:offset + length]), len(data), table)
            list(bad.span(0, len(every)))


ODD = [
    "", " ", "  a", "a  b", "a\n\nb c", "a \n b", "tab\t x", "don't  stop'll", "x y  z", "　",
    "end  ", "<|endoftext|>", "a <|endoftext|> b", "  <|endoftext|>\n", "a\x1cb \x1d c", "é 日本 語",
    "1 2  33\r\n4", "a​b", "😀 😀😀  x", "\x85a\xa0b \xa0 c"]


def test_pieces_give_what_whole_texts_give(monkeypatch):
    ids = token_files.PieceIds(open(tokenizer_path()).read())
    assert ids.by_word
    rng = random.Random(5)
    signs = list(" \n\t \x1c'ab1!é日<|😀") + ["  ", "'s", "<|endoftext|>", "word"]
    texts = ODD + ["".join(rng.choices(signs, k=rng.randint(1, 30))) for _ in range(3000)]
    for known in (10**6, 3000, 0):
        monkeypatch.setattr(token_files, "KNOWN_WORDS", known)
        monkeypatch.setattr(token_files, "BLOCK_BYTES", 50 if known else 1 << 19)
        if known == 3000:
            # All words have one hash: every place is compared, so nothing changes.
            monkeypatch.setattr(token_files, "word_hashes", lambda data: (
                *words.word_hashes(data)[:2], words.word_hashes(data)[2] * np.uint64(0)))
        fresh = token_files.PieceIds(open(tokenizer_path()).read())
        for begin in range(0, len(texts), 100):
            some = texts[begin:begin + 100]
            for text, found in zip(some, fresh.of([t.encode() for t in some])):
                assert found.tobytes() == ids.whole(text), repr(text)
        assert fresh.of([None])[0].tolist() == []


def test_words_of_letters_go_to_the_model(monkeypatch):
    """The library's split is spared for them, whatever letters and marks they have."""
    ids = token_files.PieceIds(open(tokenizer_path()).read())
    rng = random.Random(7)
    letters = [chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0x250)] if c not in (0xD7, 0xF7)]
    texts = [
        sep.join(
            "".join(rng.choices(letters, k=rng.randint(1, 12))) + "".join(rng.choices(".,;:!?", k=rng.randint(0, 3)))
            for _ in range(50)) for sep in (" ", "\n") for _ in range(40)]
    expected = [ids.whole(text) for text in texts]
    looked_at = []
    whole = ids.whole
    monkeypatch.setattr(ids, "whole", lambda text: looked_at.append(text) or whole(text))
    assert [found.tobytes() for found in ids.of([t.encode() for t in texts])] == expected
    assert not looked_at
    # Signs between and before letters are left to the split.
    odd = ["a\u00d7b \u00f7c don't 'll x.y .z a\u02b0 \u0250 1a a1 a\u0301 \u00aa", "it's,\nwe'll. \u0141\u00f3d\u017a!?"]
    assert [f.tobytes() for f in ids.of([t.encode() for t in odd])] == [whole(t) for t in odd]
    assert looked_at


def _expected(texts, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    start = 0
    for key, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + end
        yield key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


@tables
def test_token_files_of_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()
    rows = QUERIES["op11_token_files"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == list(
        _expected([(d.doc_id, d.text) for d in docs], [END_ID]))


@tables
def test_many_files_and_ranges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    folder = new_run_dir(spark, "tokens")
    manifest = token_files.write_tokens(docs, folder, tokenizer_path(), END_ID, file_bytes=50_000).collect()
    assert len(manifest) > 3 and sum(r.docs for r in manifest) == docs.count()
    rows = token_files.read_tokens(spark, folder, with_ids=True, split=3_000).collect()
    texts = [(d.doc_id, d.text) for d in docs.orderBy("doc_id").collect()]
    assert sorted(tuple(r)[:4] for r in rows) == list(_expected(texts, [END_ID]))
    assert all(zlib.crc32(r.token_ids) == r.ids_crc32 and len(r.token_ids) == 4 * r.n_tokens for r in rows)
    whole = b"".join(r.token_ids for r in sorted(rows, key=lambda r: r.start))
    assert len(whole) == 4 * sum(r.ids for r in manifest)


@pytest.mark.parametrize("end", [None, END_ID])
def test_token_files_of_odd_rows(spark, edges, nothing, end):
    folder = new_run_dir(spark, "tokens")
    token_files.write_tokens(edges, folder, tokenizer_path(), end, file_bytes=20_000)
    rows = token_files.read_tokens(spark, folder).orderBy("start", "n_tokens").collect()
    texts = [(r.doc_id, r.text) for r in edges.collect()]
    want = _expected(sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0)), [] if end is None else [end])
    assert collections.Counter((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows) == (
        collections.Counter(want))
    empty = new_run_dir(spark, "tokens")
    assert token_files.write_tokens(nothing, empty, tokenizer_path(), end).collect() == []
    assert token_files.read_tokens(spark, empty).collect() == []


# --- clusters


def _plain(vectors, k, rounds, seed=3):
    """vectors: (id, list of int). Everything in Python integers."""
    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def order(row):
        name = None if row[0] is None else hashlib.sha256(f"{seed}:{row[0]}".encode()).hexdigest()
        return name is None, name or "", row[1]

    centroids = [list(v) for _, v in sorted(vectors, key=order)[:k]]
    for r in range(rounds + 1):
        at = [min((distance(v, c), j) for j, c in enumerate(centroids)) for _, v in vectors]
        if r == rounds:
            break
        for j in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(vectors, at) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    inertia = collections.Counter()
    for d, j in at:
        inertia[j] += d
    return sorted(
        (i is None, i or 0, j, d, inertia[j], sum(inertia.values()),
         hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest())
        for (i, _), (d, j) in zip(vectors, at))


def _sorted(rows):
    return sorted(
        (r.vec_id is None, r.vec_id or 0, r.cluster, r.distance, r.cluster_inertia, r.inertia,
         r.centroid_sha256) for r in rows)


def test_bounds_never_change_an_assignment():
    rng = np.random.default_rng(11)
    spared = total = 0
    for case in range(30):
        k, dims = int(rng.integers(2, 20)), int(rng.integers(1, 6))
        # Few values, so that there are many ties and equal centroids.
        spread = int(rng.choice([2, 5, 1000]))
        centres = rng.integers(-spread, spread, (k, dims))
        vectors = rng.integers(-spread, spread, (400, dims)) + centres[rng.integers(0, k, 400)]
        centroids = vectors[rng.choice(400, k, replace=False)].astype(np.int64)
        n = len(vectors)
        state = (np.zeros(n, np.int32), np.ones(n, np.int32), np.full(n, np.inf), np.zeros(n))
        moved = np.zeros(k)
        for _ in range(8):
            state, measured = clusters.assign(vectors, state, clusters.Geometry(centroids, moved))
            squares = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
            assert (state[0] == squares.argmin(axis=1)).all()
            spared, total = spared + n * k - measured, total + n * k
            old, centroids = centroids, centroids.copy()
            for j in range(k):
                if (state[0] == j).any():
                    centroids[j] = vectors[state[0] == j].sum(axis=0) // np.count_nonzero(state[0] == j)
            moved = np.sqrt(((centroids - old) ** 2).sum(axis=1))
    assert spared > total / 4


@tables
def test_clusters_of_the_table(spark):
    rows = [
        (r.vec_id, [int(np.floor(1024 * float(x))) for x in r.embedding])
        for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
        if r.embedding is not None and len(r.embedding) == 64
        and all(x is not None and np.isfinite(x) for x in r.embedding)]
    assert _sorted(QUERIES["op12_shallot_clusters"](spark, SF).collect()) == _plain(rows, 8, 10)


def test_clusters_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [0.5, 1.0]), (3, None), (4, [nan, 1.0]), (5, [1.0, None]),
        (6, [-0.1, -7.3]), (None, [3.0, 3.0]), (7, [inf, 0.0]), (8, [1.0]), (9, [0.0, 0.0]), (10, []),
        (11, [-3.0, 2.2]), (12, [1e30, 0.0]), (13, [4.0, 3.0])]
    table = spark.createDataFrame(
        [(*r, 7, "x") for r in rows], "vec_id long, embedding array<double>, cluster int, id string")
    sound = [
        (i, [int(np.floor(1024 * x)) for x in v]) for i, v in rows
        if v and len(v) == 2 and all(x is not None and abs(x) < 1e6 for x in v)]
    for k, rounds in ((1, 2), (3, 0), (3, 4), (50, 2)):
        found = clusters.cluster(table, k=k, rounds=rounds, dims=2).collect()
        assert _sorted(found) == _plain(sound, k, rounds), (k, rounds)
    assert clusters.cluster(table.filter("vec_id > 99"), dims=2).collect() == []


# --- source audit


def _audit(rows, least_docs, top):
    term = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    docs, counts = collections.defaultdict(set), collections.Counter()
    groups = collections.defaultdict(set)
    for k, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for found in term.findall(text or ""):
            found = "".join(c.lower() if "A" <= c <= "Z" else c for c in found)
            docs[lang, found].add(k)
            counts[lang, source, found] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (of, t), held in docs.items() if of == lang and len(held) >= least_docs]

        def shares(names):
            n = {t: sum(counts[lang, s, t] for s in names) for t in kept}
            total = sum(n.values())
            return {t: 1 + 10**9 * (c + 2) // (total + 2 * len(kept)) for t, c in n.items()}, n

        every, _ = shares(sources)
        for a in sources:
            p, n = shares([a])
            pairs = []
            for b in sources - {a}:
                q, _ = shares([b])
                pairs.append((b, sum((p[t] - q[t]) ** 2 // (p[t] + q[t]) for t in kept)))
            terms = [
                (t, (p[t] - every[t]) ** 2 // (p[t] + every[t])) for t in kept if n[t] and p[t] > every[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, a, part, i, v, r) for r, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def _random_rows(seed, n=300):
    rng = random.Random(seed)
    words = ["Foo", "foo,", "(foo)", "bar-foo", "é1è", "日本", "x", "x!", "Z9z", "12", "--", "😀a"] + [
        f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)]
    return [
        (" ".join(rng.choices(words, weights=[60 // (k + 1) + 1 for k in range(len(words))],
                              k=rng.randint(0, 12))).replace(" ", rng.choice([" ", "\n", " \t "])),
         rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "a", "b", None, "é"]))
        for _ in range(n)]


def test_hashes_and_filter_of_chunks():
    rng = random.Random(2)
    some = ["".join(rng.choices("ab\x00é日", k=rng.randint(1, 9))).encode() for _ in range(3000)]
    text = b"".join(w + rng.choice([b" ", b"\n", b" \t\x0b\x0c\r "]) for w in some)
    start, stop, hashes = words.word_hashes(np.frombuffer(text, np.uint8))
    assert [text[a:b] for a, b in zip(start, stop)] == text.split()
    # A hash depends on the chunk alone, not on its place.
    by_word = dict(zip(text.split(), hashes.tolist()))
    assert [by_word[w] for w in text.split()] == hashes.tolist()
    assert len(set(by_word.values())) == len(by_word)
    held = divergence.Filter(1 << 16)
    some = np.array(sorted(set(by_word.values())), np.uint64)[::2]
    held.add(some)
    assert set(some.tolist()) <= set(hashes[held.held(hashes)].tolist())
    assert len(set(hashes[held.held(hashes)].tolist())) < len(some) * 1.2
    assert len(words.word_hashes(np.empty(0, np.uint8))[2]) == 0


@pytest.mark.parametrize("held", [1, divergence.HELD_CHUNKS])
def test_audit_against_plain_code(spark, monkeypatch, held):
    # Tables emptied after every document, and cells in many blocks, change nothing.
    monkeypatch.setattr(divergence, "HELD_CHUNKS", held)
    monkeypatch.setattr(divergence, "LONG_TEXT", 20 if held == 1 else divergence.LONG_TEXT)
    monkeypatch.setattr(divergence, "CELLS", divergence.CELLS if held > 1 else 3)
    rows = _random_rows(held)
    table = spark.createDataFrame(
        [(*r, "t", 1) for r in rows], "text string, lang string, source string, term string, chunk int"
    ).repartition(5)
    found = divergence.divergence(table, 10, 4).collect()
    assert sorted(map(tuple, found)) == _audit(rows, 10, 4)


def test_audit_of_odd_rows(spark, edges, nothing):
    rows = [(r.text, r.lang, r.source) for r in edges.collect()]
    assert sorted(map(tuple, divergence.divergence(edges, 2).collect())) == _audit(rows, 2, 10)
    assert sorted(map(tuple, divergence.divergence(edges, 99).collect())) == _audit(rows, 99, 10)
    assert divergence.divergence(nothing).collect() == []
    longest = spark.createDataFrame([("x" * 2_000_000, "en", "a"), ("x" * 2_000_000, "en", "b")],
                                    "text string, lang string, source string")
    assert len(divergence.divergence(longest, 2).filter(F.col("part") == "pair").collect()) == 2


def test_remembered_words_stay_small():
    """What a worker remembers of 20,000 words, times how many it may, is within 75 MB."""
    import sys

    ids = token_files.PieceIds(open(tokenizer_path()).read())
    ids.of([" ".join(f"word{n}" for n in range(100_000, 120_000)).encode()])
    held = sys.getsizeof(ids.known) + sum(
        sys.getsizeof(word) + sys.getsizeof(packed) for word, packed in ids.known.items())
    assert held / len(ids.known) * token_files.KNOWN_WORDS < 75e6
