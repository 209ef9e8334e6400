"""Random small inputs against plain Python models of what each operator should say."""

import fnmatch
import random
from datetime import datetime, timedelta

import pytest

from lading.operators.acl import acl_compare
from lading.plans import sync
from lading.plans import validate as checks
from lading.plans.options import SyncOptions, ValidateOptions
from lading.schemas import ACL, HEAD

START = datetime(2024, 1, 1)


def _names(rng, n):
    return [
        rng.choice(["a/", "b/", ""]) + rng.choice(["x", "y", "zz"]) + str(i)
        + rng.choice([".txt", ".tmp", ".log"]) for i in range(n)]


def _listing(spark, rows):
    return spark.createDataFrame(
        rows, "key string, size long, etag string, last_modified timestamp_ntz"
    ).selectExpr("'b' as bucket", "key", "last_modified", "size",
                 "cast(null as string) as storage_class", "etag",
                 "cast(null as string) as version_id")


def _model(source, target, done, since, exclude, include, sp, tp):
    """Action of every source row and orphan, spelled out row by row."""
    by_rel = {
        k[len(tp):]: (s or 0, (e or "").strip('"'), at) for k, s, e, at in target if k.startswith(tp)}
    plan = {}

    def allowed(key):
        if any(fnmatch.fnmatchcase(key, p) for p in exclude):
            return False
        return not include or any(fnmatch.fnmatchcase(key, p) for p in include)

    for key, size, etag, at in source:
        if not key.startswith(sp):
            continue
        rel, tag = key[len(sp):], (etag or "").strip('"')
        why = "missing"
        if rel in by_rel:
            t_size, t_tag, t_at = by_rel[rel]
            # A blank ETag decides nothing: then sizes do, then times.
            up_to_date = tag and t_tag or (at is not None and t_at is not None and at <= t_at)
            why = (
                "etag" if tag and t_tag and tag != t_tag else
                "size" if t_size != (size or 0) else None if up_to_date else "time")
        if key in done:
            plan[key] = ("skip_checkpoint", None)
        elif since and at is not None and at < since:
            plan[key] = ("skip_since", None)
        elif why is None:
            plan[key] = ("unchanged", None)
        elif not allowed(key):
            plan[key] = ("filtered", None)
        else:
            plan[key] = ("copy", why)
    rels = {k[len(sp):] for k, *_ in source if k.startswith(sp)}
    for rel in by_rel:
        if rel not in rels:
            plan[tp + rel] = ("delete", "orphan")
    return plan


@pytest.mark.parametrize("seed", range(6))
def test_plan(spark, seed):
    rng = random.Random(seed)
    sp, tp = rng.choice([("", ""), ("s/", "t/"), ("s/", "")])
    names = _names(rng, 60)

    def row(prefix, name):
        return (prefix + name, rng.choice([None, 0, 1, 2]), rng.choice([None, "", '"q"', "q", "r"]),
                rng.choice([None, START + timedelta(hours=rng.randrange(48))]))

    source = [row(sp, n) for n in names if rng.random() < 0.8] + [row("elsewhere/", "x")]
    target = [row(tp, n) for n in names if rng.random() < 0.7]
    done = {k for k, *_ in source if rng.random() < 0.2}
    since = rng.choice([None, START + timedelta(hours=20)])
    exclude, include = rng.choice([
        ([], []), (["*.tmp"], []), (["*x?.*", "b/*"], ["*.txt", "*[0-5].log"]), ([], ["*/y*"])])
    options = SyncOptions("sb", "tb", sp, tp, since and str(since), delete=True,
                          exclude_patterns=tuple(exclude), include_patterns=tuple(include))
    checkpoint = spark.createDataFrame(
        [("sb", "tb", k) for k in done] + [("sb", "other", k) for k, *_ in source],
        "source_bucket string, target_bucket string, key string")
    plan = sync.mirror_plan(
        _listing(spark, source), _listing(spark, target), options, checkpoint, all_rows=True)
    expected = _model(source, target, done, since, exclude, include, sp, tp)
    got = {(r.key, r.action == "delete"): (r.action, r.reason) for r in plan.collect()}
    assert got == {(k, v[0] == "delete"): v for k, v in expected.items()}
    left_only = sync.sync_plan(
        _listing(spark, source), _listing(spark, target), options, checkpoint,
        small_source=bool(seed % 2))
    assert {r.key: (r.action, r.reason) for r in left_only.collect()} == {
        k: v for k, v in expected.items() if v[0] != "delete"}


def _pairs_agree(left, right):
    def ordered(grants):
        return sorted(grants, key=lambda g: (g[0][3] or "", g[1]))

    return len(left) == len(right) and all(
        a[1] == b[1] and (a[0][3] == b[0][3] or a[0][1] == b[0][1])
        for a, b in zip(ordered(left), ordered(right)))


def test_grants(spark):
    rng = random.Random(11)

    def grants():
        return [
            ((rng.choice(["CanonicalUser", "Group"]), rng.choice([None, "i", "j"]), None,
              rng.choice([None, "u", "v"]), None), rng.choice(["READ", "WRITE"]))
            for _ in range(rng.randrange(4))]

    rows = [(f"k{i}", grants()) for i in range(400)]
    others = [(k, rng.sample(g, len(g)) if rng.random() < 0.5 else grants()) for k, g in rows]

    def lists(side):
        return spark.createDataFrame([("b", k, ("o", None), g) for k, g in side], ACL)

    expected = dict(zip((k for k, _ in rows), (
        _pairs_agree(g, h) for (_, g), (_, h) in zip(rows, others))))
    got = {r.key: r.match for r in acl_compare(lists(rows), lists(others)).collect()}
    assert got == expected and 0 < sum(expected.values()) < 400
    strict = {r.key: r.match for r in acl_compare(lists(rows), lists(others), "strict").collect()}

    def bag(side):
        return sorted((g[0][0], g[0][3] or g[0][1] or "", g[1]) for g in side)

    assert strict == {k: bag(g) == bag(h) for (k, g), (_, h) in zip(rows, others)}


def test_validation(spark):
    rng = random.Random(5)

    def head(key):
        return {
            "key": key, "content_length": rng.choice([1, 2]), "etag": rng.choice(["", "e", "f"]),
            "content_type": rng.choice([None, "t"]), "metadata": rng.choice([None, {}, {"a": "b"}])}

    keys = [f"k{i}" for i in range(200)]
    left = {k: head(k) for k in keys}
    right = {k: head(k) for k in keys if rng.random() < 0.8}
    md5 = {k: (rng.choice("xy"), rng.choice("xy")) for k in keys}

    def table(heads):
        return spark.createDataFrame(
            [tuple(h.get(f.name) for f in HEAD.fields) for h in heads.values()], HEAD)

    def digests(side):
        return spark.createDataFrame([(k, v[side]) for k, v in md5.items()], "key string, md5 string")

    sizes = {k: h["content_length"] for k, h in left.items()}
    listing = _listing(spark, [(k, n, "", None) for k, n in sizes.items()])
    options = ValidateOptions(check_acl=False, digest_limit=1)
    rows = {r.key: r for r in checks.validate(
        listing, table(left), table(right), options, source_digests=digests(0),
        target_digests=digests(1)).collect()}
    assert set(rows) == set(keys)
    for key in keys:
        row, s, t = rows[key], left[key], right.get(key)
        if t is None:
            assert (row.success, row.content_ok, row.metadata_ok) == (False, None, None)
            continue
        same = s["content_length"] == t["content_length"] and (
            not s["etag"] or not t["etag"] or s["etag"] == t["etag"]) and (
            sizes[key] > 1 or md5[key][0] == md5[key][1])
        wrong = [f for f, column in (("ContentType", "content_type"), ("ContentLength", "content_length"))
                 if s[column] != t[column]]
        wrong += ["Metadata"] if (s["metadata"] or {}) != (t["metadata"] or {}) else []
        assert (row.content_ok, row.metadata_ok) == (same, not wrong), key
        assert row.success == (same and not wrong)
        assert [e for e in row.errors if e.startswith("meta")] == [
            f"metadata_mismatch: {f}" for f in wrong]
    summary = checks.validation_summary(
        spark.createDataFrame(list(rows.values()), checks_schema()), options).first()
    assert summary.total_objects == 200
    assert summary.content_passed == sum(bool(r.content_ok) for r in rows.values())
    assert summary.metadata_failed == 200 - sum(bool(r.metadata_ok) for r in rows.values())


def checks_schema():
    from lading.schemas import VALIDATION

    return VALIDATION
