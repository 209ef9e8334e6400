"""URL templates against a plain tree, and the pipeline's stages on odd rows."""

import collections
import importlib
import math
import random
import re
import sys

import pytest
from pyspark.sql import functions as F

from lading.llm import mixing, stages, templates
from lading.llm.queries import URL_RULES, tokenizer_path


def _kind(segment):
    stem, ending = re.fullmatch(r"(?s)(.*?)(\.[A-Za-z]{1,5})?", segment).groups()
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", stem):
        stem = "{date}"
    elif re.fullmatch(r"[0-9]+", stem):
        stem = "{n}"
    elif re.fullmatch(r"(?=.*[0-9])[0-9A-Fa-f-]{8,}", stem):
        stem = "{hex}"
    return stem + (ending or "")


def _tree(urls):
    """Verdicts of labelled urls (host, path, bad or None) by walking the tree with plain code."""
    rows = [(host, [_kind(s) for s in path.split("/") if s], bad) for host, path, bad in urls]
    template = [host for host, _, _ in rows]
    for depth in range(max((len(s) for _, s, _ in rows), default=0)):
        kids = collections.defaultdict(lambda: collections.defaultdict(list))
        for k, (_, segments, _) in enumerate(rows):
            if len(segments) > depth:
                kids[template[k]][segments[depth]].append(k)
        for children in kids.values():
            labels = {
                s: [rows[k][2] for k in members if rows[k][2] is not None]
                for s, members in children.items()}
            known = [b for of in labels.values() for b in of]
            rate = sum(known) / len(known) if known else None
            side, like, few = {}, {}, {s for s, m in children.items() if len(m) < templates.SELDOM}
            for s, members in children.items():
                n = len(labels[s])
                if not n:
                    side[s] = "unknown"
                else:
                    off, wide = sum(labels[s]) - n * rate, 2 * math.sqrt(n * rate * (1 - rate))
                    side[s] = "worse" if off > wide else "better" if off < -wide else "usual"
                after = {(rows[k][1] + [""])[depth + 1] if len(rows[k][1]) > depth + 1 else ""
                         for k in members}
                like[s] = side[s], tuple(sorted({
                    "." if not a else "{}" if a.startswith("{") else "a" for a in after}))
            judged = sum(bool(labels[s]) for s in few)
            ruled = 2 * judged - len(few) > 2 * math.sqrt(len(few))
            name = {}
            for s in few:
                if side[s] == "unknown" or (ruled and side[s] == "usual"):
                    name[s] = "*"
                elif ruled:
                    name[s] = "*" + side[s]
            rest = collections.defaultdict(list)
            for s in children:
                if s not in name:
                    rest[like[s]].append(s)
            for group in rest.values():
                for s in group:
                    name[s] = min(group) + "|.." if len(group) > 1 else s
            for s, members in children.items():
                for k in members:
                    template[k] += "/" + name[s]
    counted = collections.defaultdict(list)
    for k, (_, _, bad) in enumerate(rows):
        counted[template[k]].append(bad)
    out = []
    for t in template:
        known = [b for b in counted[t] if b is not None]
        out.append((t, (sum(known) + 0.4) / (len(known) + 2)))
    return out


def _judged(spark, urls, rules=URL_RULES):
    table = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return {r.page_id: r for r in templates.judge(table, rules).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_templates_against_a_plain_tree(spark, seed):
    rng = random.Random(seed)
    hosts = ["a.example.com", "example.com", "b.net", "c.org", "d.example.net"]
    names = ["de", "fr", "en", "news", "17", "2024-01-01", "x.html", "0badcafe1", "y"]
    urls = []
    for k in range(500):
        depth = rng.choice([0, 1, 1, 2, 2, 3, 6, 40])
        parts = [rng.choice(names) if rng.random() < 0.8 else f"s{rng.randint(0, 60)}" for _ in range(min(depth, 6))]
        parts += [f"t{j}" for j in range(depth - len(parts))]
        urls.append("https://" + rng.choice(hosts) + "/" + "/".join(parts))
    found = _judged(spark, urls)
    paths = [("/".join(u.split("/")[2:3]), "/" + "/".join(u.split("/")[3:])) for u in urls]
    # What comes after the last level is one segment, whatever stands in it.
    deep = [
        (h, p if len(p.split("/")) <= templates.MOST_LEVELS + 1 else "/".join(
            p.split("/")[:templates.MOST_LEVELS + 1]) + "/" + "\x00".join(
            p.split("/")[templates.MOST_LEVELS + 1:]), found[k].rule and (found[k].verdict == "block"))
        for k, (h, p) in enumerate(paths)]
    deep = [(h, p, None if bad is None else bad) for h, p, bad in deep]
    for k, (template, purity) in enumerate(_tree(deep)):
        row = found[k]
        assert (row.template, round(row.purity, 9)) == (template.replace("\x00", "/"), round(purity, 9)), urls[k]
        assert row.rule or row.verdict == ("block" if purity > 0.5 else "allow")


@pytest.mark.parametrize("ones", [1, 18, 19, 20, 1000])
@pytest.mark.parametrize("labelled", [2, 600])
def test_a_labelled_branch_does_not_speak_for_others(spark, ones, labelled):
    urls = [f"http://example.com/de/{k}" for k in range(labelled)] + [
        f"http://example.com/seg{k}x/{k}" for k in range(ones)]
    found = _judged(spark, urls)
    assert {found[k].verdict for k in range(labelled)} == {"block"}
    assert {found[labelled + k].verdict for k in range(ones)} == {"allow"}


def test_many_judged_branches_speak_for_the_seldom_rest(spark):
    table = spark.createDataFrame(
        [(k, "h.example", [f"s{k}", "{n}"], True if k < 40 else None) for k in range(45)],
        "page_id long, host string, segments array<string>, bad boolean"
    ).withColumn("leaf", F.concat_ws("/", "host", "segments"))
    found = templates.purities(table.select("leaf", "host", "segments", "bad")).collect()
    assert len(found) == 45 and all(r.rejected for r in found)


def test_all_levels_of_a_path_count(spark):
    bad = [f"http://x.com/a/b/c/d/e/bad/{k}" for k in range(30)]
    good = [f"http://x.com/a/b/c/d/e/good/{k}" for k in range(30)]
    rules = (templates.Rule("block", "x.com", "/a/b/c/d/e/bad/1"), templates.Rule("allow", "x.com", "/a/b/c/d/e/good/1"))
    found = _judged(spark, bad + good, rules)
    assert {found[k].verdict for k in range(30)} == {"block"}
    assert {found[30 + k].verdict for k in range(30)} == {"allow"}
    assert found[0].template.count("/") == 7


STAGES = {
    "quality_classifier": lambda s, d: stages.quality_classifier(d, s.createDataFrame(
        [(4, 1), (5, None), (None, 1), (7, 0), (8, 0)], "doc_id long, quality int")),
    "near_dedup": lambda s, d: stages.near_dedup(d),
    "substring_dedup": lambda s, d: stages.substring_dedup(d),
    "source_mixing": lambda s, d: stages.source_mixing(d),
    "bpe": lambda s, d: stages.bpe_round_trip(d, tokenizer_path()),
}


@pytest.mark.parametrize("name", STAGES)
def test_stages_on_odd_rows_and_none(spark, edges, nothing, name):
    out = STAGES[name](spark, edges)
    assert out.columns[:len(edges.columns)] == edges.columns
    texts = {(r.doc_id, r.text) for r in edges.collect()}
    rows = out.collect()
    if name != "substring_dedup":
        assert {(r.doc_id, r.text) for r in rows} <= texts
    assert rows
    assert STAGES[name](spark, nothing).collect() == []


def test_near_dedup_keeps_other_texts_of_an_id(spark):
    a, b = (" ".join(f"{w}{k}" for k in range(30)) for w in "ab")
    rows = [(3, a), (7, b), (7, a), (7, b), (9, None), (9, None), (None, a), (None, a)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = collections.Counter((r.doc_id, r.text) for r in stages.near_dedup(table).collect())
    assert kept == {(3, a): 1, (7, b): 1, (9, None): 1, (None, a): 1}


def test_bpe_stage_with_names_of_its_own(spark):
    names = ("doc_id", "text", "decoded", "token_ids", "ids", "_ids", "c0", "round_trip", "n_tokens")
    table = spark.createDataFrame(
        [(1, "some words", "d", "t", 2, 3, "c", "r", 4), (2, None, None, None, None, None, None, None, None)],
        "doc_id long, text string, decoded string, token_ids string, ids long, _ids long, c0 string,"
        " round_trip string, n_tokens long")
    rows = stages.bpe_round_trip(table, tokenizer_path()).collect()
    assert rows[0].__fields__ == [n for n in names if n not in ("token_ids", "round_trip", "n_tokens")] + [
        "n_tokens", "token_ids", "round_trip"]
    assert all(r.round_trip and len(r.token_ids) == 4 * r.n_tokens for r in rows)
    assert (rows[0].decoded, rows[0].ids, rows[0].c0, rows[0].n_tokens) == ("d", 2, "c", 2)


def test_the_mix_alters_no_text(spark):
    rng = random.Random(4)
    rows = [(k, "\n".join(f"w{rng.randint(0, 9)}" for _ in range(rng.randint(0, 60))), "en",
             rng.choice(["a", "b", "c"])) for k in range(60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    mixed = stages.source_mixing(table).collect()
    texts = {(k, t) for k, t, _, _ in rows}
    assert {(r.doc_id, r.text) for r in mixed} <= texts
    words = collections.Counter()
    for r in mixed:
        words[r.source] += len(r.text.split())
    longest = max(len(t.split()) for _, t, _, _ in rows)
    for r in mixing.mix(table).select("source", "target").distinct().collect():
        assert abs(words[r.source] - r.target) <= longest / 2 + 1


def test_the_entry_stands_without_packages_of_operators(monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setitem(sys.modules, "xxhash", None)
    gone = {n: m for n, m in sys.modules.items() if n.startswith("lading.llm") or n == "corpus_pipeline"}
    for name in gone:
        monkeypatch.delitem(sys.modules, name)
    try:
        bare = importlib.reload(entry)
        assert bare.queries() and not any(n.startswith("op") and n[2].isdigit() for n in bare.queries())
        assert "pipeline" not in bare.queries()
    finally:
        monkeypatch.undo()
        sys.modules.update(gone)
        importlib.reload(entry)
    assert "pipeline" in entry.queries()
