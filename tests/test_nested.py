import pytest
from pyspark.sql import functions as F

from lading.constants import ALL_USERS, ALL_USERS_HTTP, AUTHENTICATED_USERS
from lading.functions import acl as acl_fn
from lading.functions.maps import (
    map_equal, map_literal, metadata_merge, metadata_normalize, metadata_replace,
)
from lading.operators import acl, metadata
from lading.plans import validate as checks
from lading.plans.options import ValidateOptions
from lading.schemas import ACL, HEAD, RAW_ACL
from lading.sources.acls import acl_scan
from lading.sources.heads import head_scan, object_info
from lading.sources.inventory import latest_per_key


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


def heads(spark, *rows):
    return spark.createDataFrame(
        [tuple(r.get(f.name) for f in HEAD.fields) for r in rows], HEAD)


def test_replace_drops_old_entries(spark):
    got = _one(spark, metadata_replace(
        map_literal({"old": "value"}), map_literal({"new": "value", "added": "field"})))
    assert got == {"new": "value", "added": "field"}
    assert _one(spark, metadata_replace(map_literal({"old": "v"}), map_literal({}))) == {"old": "v"}


def test_merge_keeps_and_overrides(spark):
    got = _one(spark, metadata_merge(
        map_literal({"original": "keep", "x": "1"}), map_literal({"added": "new", "x": "2"})))
    assert got == {"original": "keep", "added": "new", "x": "2"}
    none = F.lit(None).cast("map<string,string>")
    assert _one(spark, metadata_merge(none, map_literal({"a": "b"}))) == {"a": "b"}


def test_map_equality_ignores_order(spark):
    left, right = map_literal({"a": "1", "b": "2"}), map_literal({"b": "2", "a": "1"})
    assert _one(spark, map_equal(left, right))
    assert not _one(spark, map_equal(left, map_literal({"a": "1"})))
    assert _one(spark, map_equal(F.lit(None).cast("map<string,string>"), map_literal({})))


def test_header_names(spark):
    got = _one(spark, metadata_normalize(map_literal({
        "Content-Type": "t", "CONTENT-LENGTH": "5", "content-md5": "m", "Last-Modified": "l",
        "ETag": "first", "etag": "second", "Storage-Class": "s", "Cache-Control": "c",
        "EXPIRES": "e", "X-Amz-Meta-Project": "p", "x-amz-meta-Team": "q", "X-Other": "o"})))
    assert got == {
        "ContentType": "t", "ContentLength": "5", "ContentMD5": "m", "LastModified": "l",
        "ETag": "second", "StorageClass": "s", "CacheControl": "c", "Expires": "e",
        "Project": "p", "Team": "q", "X-Other": "o"}


def test_head_defaults(spark):
    got = head_scan(heads(spark, {"key": "k", "etag": '"e"'})).first()
    assert (got.etag, got.storage_class, got.metadata) == ("e", "STANDARD", {})


def test_point_lookup_by_version(spark):
    table = heads(spark, {"key": "k", "version_id": "1", "etag": "a"},
                  {"key": "k", "version_id": "2", "etag": "b"}, {"key": "l", "etag": "c"})
    assert object_info(table, "k", "2").first().etag == "b"
    assert object_info(table, "l").count() == 1 and object_info(table, "none").count() == 0


def test_newest_head_of_a_key(spark):
    from datetime import datetime

    table = heads(
        spark, *[{"key": "k", "metadata": {"v": str(i)}, "last_modified": datetime(2024, 1, i)}
                 for i in (1, 3, 2)])
    assert latest_per_key(table).first().metadata == {"v": "3"}


def test_compare_fields(spark):
    left = heads(spark, {"key": "k", "content_type": "a", "etag": "1", "metadata": {"x": "1"}})
    right = heads(spark, {"key": "k", "content_type": "a", "etag": "2",
                          "metadata": {"x": "1", "extra": "f"}})
    row = metadata.metadata_compare(left, right).first()
    assert not row.match
    assert [d.field for d in row.differences if not d.match] == ["Metadata"]
    assert [d.field for d in row.differences] == [
        "ContentType", "ContentLength", "ContentMD5", "CacheControl", "Expires", "Metadata"]
    assert metadata.metadata_compare(left, right, ["ContentType", "NoSuchField"]).first().match
    assert metadata.metadata_compare(left, right, []).first().match
    assert not metadata.metadata_compare(left, right, ["ETag"]).first().match
    same = metadata.metadata_compare(left, left).first()
    assert same.match and "Metadata" not in [d.field for d in same.differences]


def test_batch_update_reports_unknown_keys(spark):
    table = heads(spark, {"key": "k", "metadata": {"a": "1"}})
    keys = spark.createDataFrame([("k",), ("gone",)], "key string")
    rows = {r.key: r for r in metadata.metadata_batch_update(
        table, keys, {"b": "2"}, "COPY").collect()}
    assert rows["k"].success and rows["k"].metadata == {"a": "1", "b": "2"}
    assert not rows["gone"].success and rows["gone"].error and rows["gone"].metadata is None
    with pytest.raises(ValueError):
        metadata.metadata_batch_update(table, keys, {}, "MERGE")


def test_metadata_copy(spark):
    table = heads(spark, {"key": "k", "metadata": {"a": "1"}})
    mapping = spark.createDataFrame([("k", "t")], "source_key string, target_key string")
    assert metadata.metadata_copy(table, mapping).first().metadata == {"a": "1"}
    given = metadata.metadata_copy(table, mapping, False, {"b": "2"}).first()
    assert given.metadata == {"b": "2"}
    assert metadata.metadata_copy(table, mapping, False).first().metadata == {"a": "1"}


# Access control.

def grant(kind, permission, id=None, name=None, uri=None):
    return ((kind, id, name, uri, None), permission)


def acls(spark, *rows):
    return spark.createDataFrame([("b", *r) for r in rows], ACL)


def test_scan_of_object_and_bucket_lists(spark):
    raw = spark.createDataFrame(
        [("b", "k", ("o", None), [(("CanonicalUser", "i", "n", None), "READ")]),
         ("b", None, ("o", "d"), [(("Group", None, "n", "u"), "READ")]), ("b", "e", ("o", "d"), None)],
        "bucket string, key string, " + ", ".join(
            f"{f.name} {f.dataType.simpleString()}" for f in RAW_ACL.fields))
    rows = {r.key: r for r in acl_scan(raw).collect()}
    assert rows["k"].grants[0].grantee.display_name == "n"
    assert rows[None].grants[0].grantee.display_name is None
    assert rows["e"].grants == []


@pytest.mark.parametrize("left, right, reference, strict", [
    ([], [], True, True),
    ([grant("CanonicalUser", "READ", "a")], [grant("CanonicalUser", "READ", "b")], True, False),
    ([grant("CanonicalUser", "READ", "a")], [grant("CanonicalUser", "WRITE", "a")], False, False),
    ([grant("Group", "READ", uri="u")], [grant("Group", "READ", uri="v")], True, False),
    ([grant("Group", "READ", uri="u")], [grant("CanonicalUser", "READ", "a")], False, False),
    ([grant("Group", "READ", uri="u"), grant("CanonicalUser", "WRITE", "a")],
     [grant("CanonicalUser", "WRITE", "a"), grant("Group", "READ", uri="u")], True, True),
    ([grant("CanonicalUser", "READ", "a")], [], False, False),
])
def test_compare_grants(spark, left, right, reference, strict):
    one, two = acls(spark, ("k", ("o", "x"), left)), acls(spark, ("k", ("o", "y"), right))
    assert acl.acl_compare(one, two).first().match == reference
    assert acl.acl_compare(one, two, "strict").first().match == strict


def test_owners_are_compared_by_id(spark):
    one, two = acls(spark, ("k", ("o", "x"), [])), acls(spark, ("k", ("p", "x"), []))
    row = acl.acl_compare(one, two).first()
    assert (row.match, row.owner_match, row.grants_match) == (False, False, True)
    nobody = acls(spark, ("k", (None, None), []))
    assert acl.acl_compare(nobody, nobody).first().match


def test_build_order(spark):
    built = _one(spark, acl_fn.acl_build(
        F.array(acl_fn.make_grant(F.lit("CanonicalUser"), F.lit("READ"), id=F.lit("i"))),
        True, True, True, True, True))
    assert [(g.permission, g.grantee.uri) for g in built] == [
        ("READ", None), ("READ", ALL_USERS), ("WRITE", ALL_USERS), ("FULL_CONTROL", ALL_USERS),
        ("READ_ACP", AUTHENTICATED_USERS), ("WRITE_ACP", AUTHENTICATED_USERS)]
    assert _one(spark, acl_fn.acl_build()) == []
    basic = _one(spark, acl_fn.acl_build_basic(True, True))
    assert [(g.grantee.type, g.grantee.uri, g.permission) for g in basic] == [
        ("uri", ALL_USERS_HTTP, "READ"), ("uri", ALL_USERS_HTTP, "FULL_CONTROL")]
    assert tuple(_one(spark, acl_fn.owner_build("o", "n"))) == ("o", "n")
    assert tuple(_one(spark, acl_fn.owner_build(None, "n"))) == (None, None)


def test_copy_keeps_usable_grants(spark):
    listed = acls(spark, ("k", ("o", None), [
        grant("CanonicalUser", "READ", "i", "n"), grant("CanonicalUser", "READ"),
        grant("CanonicalUser", "LIST", "i"), grant("Group", "WRITE", "x", "y", "u"),
        grant("Group", "WRITE"), grant("AmazonCustomerByEmail", "READ", "m@x"), grant(None, "READ", "i"),
    ]))
    row = acl.acl_copy(listed).first()
    assert tuple(row.owner) == ("o", "")
    assert [(tuple(g.grantee), g.permission) for g in row.grants] == [
        (("CanonicalUser", "i", "n", None, None), "READ"),
        (("Group", None, None, "u", None), "WRITE"),
        (("AmazonCustomerByEmail", None, None, None, "m@x"), "READ")]


def test_batch_copy(spark):
    listed = acls(spark, ("a/b/k", ("o", None), []))
    keys = spark.createDataFrame([("a/b/k",), ("gone/x",)], "key string")
    rows = {r.key: r for r in acl.acl_batch_copy(listed, keys, "t/").collect()}
    assert rows["a/b/k"].success and rows["a/b/k"].target_key == "t/k"
    assert not rows["gone/x"].success and rows["gone/x"].error


def test_format_and_labels(spark):
    listed = acls(spark, ("k", ("owner123", None), [
        grant("Group", "READ", uri=ALL_USERS), grant("CanonicalUser", "WRITE", "i", "n"),
        grant("CanonicalUser", "READ", "i"), grant("CanonicalUser", "READ"),
        grant("Group", "READ", uri=AUTHENTICATED_USERS), grant("Group", "READ", uri="http://x")]))
    text = listed.select(acl_fn.acl_format("owner", "grants")).first()[0]
    assert text.split("\n") == [
        "Owner: owner123 (N/A)", f"  READ: {ALL_USERS}", "  WRITE: i (n)", "  READ: i ()",
        "  READ: Unknown", f"  READ: {AUTHENTICATED_USERS}", "  READ: http://x"]
    rows = acl.acl_explode(listed).orderBy("position").collect()
    assert [r.grantee for r in rows] == [
        "AllUsers (public)", "n", "i", "N/A", "AuthenticatedUsers", "http://x"]
    empty = acls(spark, ("e", ("o", None), []))
    assert acl.acl_explode(empty).first().grantee is None
    assert acl.acl_explode(empty, keep_empty=False).count() == 0


# Validation.

def _check(spark, inventory, source, target, digests=None, **options):
    listing = inventory(*[(h["key"], h.get("listed", h.get("content_length"))) for h in source])
    given = {}
    if digests:
        for side, values in zip(("source_digests", "target_digests"), digests):
            given[side] = spark.createDataFrame(values, "key string, md5 string")
    options = ValidateOptions(check_acl=False, **options)
    rows = checks.validate(
        listing, heads(spark, *source), heads(spark, *target), options, **given)
    return {r.key: r for r in rows.collect()}, options, rows


def test_missing_target_fails_every_check(spark, inventory):
    rows, options, frame = _check(spark, inventory, [{"key": "k", "content_length": 1}], [])
    row = rows["k"]
    assert not row.success and row.content_ok is None and row.errors == [
        "Target object not found: k"]
    counts = checks.validation_summary(frame, options).first()
    assert (counts.total_objects, counts.content_passed, counts.content_failed) == (1, 0, 1)
    assert (counts.metadata_failed, counts.acl_skipped, counts.acl_failed) == (1, 1, 0)


@pytest.mark.parametrize("source, target, digests, reason", [
    ({"content_length": 1}, {"content_length": 2}, None, "Size mismatch: source=1, target=2"),
    ({"content_length": 1}, {}, None, "Size mismatch: source=1, target=None"),
    ({"etag": '"a"'}, {"etag": "b"}, None, "ETag mismatch: source=a, target=b"),
    ({"etag": "a"}, {"etag": ""}, None, None),
    ({"etag": "a", "content_length": 3}, {"etag": "a", "content_length": 3}, ("x", "y"),
     "MD5 mismatch: source=x, target=y"),
    ({"content_length": 3}, {"content_length": 3}, ("x", "x"), None),
    ({"content_length": 3}, {"content_length": 3}, (None, "x"), "body unreadable"),
    ({"content_length": 9, "listed": 6 * 1024 ** 2}, {"content_length": 9}, ("x", "y"),
     "MD5 mismatch: source=x, target=y"),
    ({"content_length": 9, "listed": 6 * 1024 ** 2, "limit": 5 * 1024 ** 2},
     {"content_length": 9}, ("x", "y"), None),
])
def test_content_rules(spark, inventory, source, target, digests, reason):
    sides = digests and [[("k", digests[0])], [("k", digests[1])]]
    limit = {"digest_limit": source["limit"]} if "limit" in source else {}
    source = {k: v for k, v in source.items() if k != "limit"}
    rows, _, _ = _check(spark, inventory, [{"key": "k", **source}], [{"key": "k", **target}],
                        sides, check_metadata=False, **limit)
    row = rows["k"]
    assert row.success == (reason is None) and row.metadata_ok
    assert row.errors == ([] if reason is None else [f"content_mismatch: {reason}"])


def test_metadata_errors_name_their_fields(spark, inventory):
    source = [{"key": "k", "content_type": "a", "metadata": {"c": "s"}, "cache_control": "x"}]
    target = [{"key": "k", "content_type": "b", "metadata": {"c": "t"}, "cache_control": "x"}]
    rows, _, _ = _check(spark, inventory, source, target, check_content=False)
    assert rows["k"].errors == ["metadata_mismatch: ContentType", "metadata_mismatch: Metadata"]
    assert rows["k"].content_ok and not rows["k"].metadata_ok
    some, _, _ = _check(spark, inventory, source, target, check_content=False,
                        metadata_fields=("CacheControl",))
    assert some["k"].success


def test_prefix_limits_the_objects(spark, inventory):
    keys = ["p/1", "p/2", "other/3"]
    table = [{"key": k, "content_length": 1} for k in keys]
    rows, options, frame = _check(spark, inventory, table, table, prefix="p/")
    assert set(rows) == {"p/1", "p/2"} and all(r.success for r in rows.values())
    assert checks.validation_summary(frame, options).first().total_objects == 2


def test_acl_check(spark, inventory):
    listing = inventory(("same", 1), ("other", 1), ("unread", 1))
    table = heads(spark, *[{"key": k, "content_length": 1} for k in ("same", "other", "unread")])
    left = acls(spark, ("same", ("o", None), []), ("other", ("o", None), []))
    right = acls(spark, ("same", ("o", None), []), ("other", ("p", None), []))
    rows = {r.key: r for r in checks.validate(
        listing, table, table, ValidateOptions(), left, right).collect()}
    assert rows["same"].success
    assert rows["other"].errors == ["acl_mismatch"] and rows["unread"].errors == ["acl_mismatch"]
    with pytest.raises(ValueError):
        checks.validate(listing, table, table, ValidateOptions())


def test_undecided_bodies(spark, inventory):
    source = [{"key": k, "content_length": 1, "etag": e} for k, e in
              (("same", "a"), ("differs", "a"), ("open", ""), ("gone", "a"))]
    target = [{"key": k, "content_length": n, "etag": "b" if k == "differs" else "a"}
              for k, n in (("same", 1), ("differs", 1), ("open", 1))]
    listing = inventory(*[(h["key"], 1) for h in source])
    got = checks.undecided_bodies(
        listing, heads(spark, *source), heads(spark, *target), ValidateOptions())
    assert sorted(r.key for r in got.collect()) == ["open", "same"]


def test_versions_do_not_multiply_rows(spark, inventory):
    """Tables with several versions per key count once: the newest head decides."""
    from datetime import datetime

    def versions(size):
        return [{"key": "k", "content_length": n, "metadata": {"n": str(n)},
                 "last_modified": datetime(2024, 1, n)} for n in range(1, size + 1)]

    source, target = heads(spark, *versions(5)), heads(spark, *versions(7)[::-1])
    listing = inventory(("k", 5))
    row = checks.validate(listing, source, target, ValidateOptions(check_acl=False)).collect()
    assert [r.errors[0] for r in row] == ["content_mismatch: Size mismatch: source=5, target=7"]
    assert metadata.metadata_compare(source, target).count() == 1
    keys = spark.createDataFrame([("k",)], "key string")
    updated = metadata.metadata_batch_update(source, keys, {"x": "y"}, "COPY").collect()
    assert [r.metadata for r in updated] == [{"n": "5", "x": "y"}]
    lists = acls(spark, *[("k", ("o", None), [])] * 3)
    assert acl.acl_compare(lists, lists).count() == 1
    assert acl.acl_batch_copy(lists, keys).count() == 1
