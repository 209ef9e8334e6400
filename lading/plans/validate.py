"""Validation of a target against its source: content, metadata, access control.

One row per source object. All sides are joined on the same key, so the source is shuffled
once; a check that is switched off adds no join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FIELD_COLUMNS, USER_METADATA_FIELD, VALIDATE_FIELDS
from ..functions.acl import grants_match
from ..functions.keys import etag_normalize, etag_parts, relative_key
from ..operators.metadata import all_match, metadata_differences
from ..sources.inventory import prefix_filter, single
from .options import ValidateOptions

def _tags(source: str = "s", target: str = "t") -> tuple[Column, Column]:
    return tuple(etag_normalize(F.col(f"{side}.etag")) for side in (source, target))


def _composite_pair() -> Column:
    """Whether the two ETags differ, and one of them at least is a digest of part digests.

    Such ETags say how a body came in, not what it is: equal bodies can have different ones.
    """
    s_tag, t_tag = _tags()
    return (s_tag != "") & (t_tag != "") & (s_tag != t_tag) & (
        etag_parts(s_tag).isNotNull() | etag_parts(t_tag).isNotNull())


def content_mismatch(
    listed_size: Column, digest_limit: int | None, with_digests: bool,
    source: str = "s", target: str = "t", with_composites: bool = False,
) -> Column:
    """Why two bodies differ, null where they agree. The first rule that applies decides:

    length, ETag (where both sides have one), then the digest for objects up to the limit. With
    ``with_composites``, ETags of which one is composite agree where ``composite_ok`` says so, and
    decide nothing else where digests are at hand.
    """
    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("None"))

    def reason(what: str, left: Column, right: Column) -> Column:
        return F.concat(
            F.lit(f"{what} mismatch: source="), shown(left), F.lit(", target="), shown(right)
        )

    s_len, t_len = F.col(f"{source}.content_length"), F.col(f"{target}.content_length")
    s_tag, t_tag = _tags(source, target)
    tags_differ = (s_tag != "") & (t_tag != "") & (s_tag != t_tag)
    proven = F.lit(False)
    if with_composites:
        proven = F.coalesce(F.col("c.composite_ok"), F.lit(False))
        tags_differ = tags_differ & ~proven
        if with_digests:
            tags_differ = tags_differ & ~_composite_pair()
    chain = F.when(~s_len.eqNullSafe(t_len), reason("Size", s_len, t_len)).when(
        tags_differ, reason("ETag", s_tag, t_tag)
    )
    if with_digests:
        s_md5, t_md5 = F.col("s_body.md5"), F.col("t_body.md5")
        within = _within(listed_size, digest_limit) & ~proven
        if with_composites:
            # Beyond the limit no body is read, so there the tags decide after all.
            chain = chain.when(
                ~within & ~proven & (s_tag != "") & (t_tag != "") & (s_tag != t_tag),
                reason("ETag", s_tag, t_tag))
        chain = chain.when(
            within & (s_md5.isNull() | t_md5.isNull()), F.lit("body unreadable")
        ).when(within & (s_md5 != t_md5), reason("MD5", s_md5, t_md5))
    return chain


def _within(listed_size: Column, digest_limit: int | None) -> Column:
    """Whether a body of this size is read; without a limit every one is."""
    if digest_limit is None:
        return F.lit(True)
    return F.coalesce(listed_size, F.lit(0)) <= digest_limit


def _compared_key(options: ValidateOptions) -> Column:
    """A source key in the form the target has it."""
    if options.target_prefix is None:
        return F.col("key")
    return F.concat(F.lit(options.target_prefix), relative_key("key", options.prefix))


def _target_side(frame: DataFrame, options: ValidateOptions) -> DataFrame:
    same = options.target_prefix is None
    return prefix_filter(frame, options.prefix if same else options.target_prefix)


def _head_columns(options: ValidateOptions, content: bool, metadata: bool) -> list[str]:
    """The head columns the checks look at; nothing else is read or shuffled."""
    wanted = {"content_length", "etag"} if content else set()
    if metadata:
        fields = options.metadata_fields or VALIDATE_FIELDS
        wanted |= {FIELD_COLUMNS[f] for f in fields if f in FIELD_COLUMNS}
        wanted |= {"metadata"} if USER_METADATA_FIELD in fields else set()
    if options.repeated_keys or not wanted:
        wanted.add("last_modified")
    return sorted(wanted)


def _sides(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame,
    options: ValidateOptions, content: bool = True, metadata: bool = False,
) -> DataFrame:
    """``target_key, key, listed_size, s, t``: listing and both heads on the compared key.

    Without a check that needs it, there is no source head ``s``.
    """
    compared = _compared_key(options).alias("target_key")
    columns = _head_columns(options, content, metadata)
    listing = single(
        prefix_filter(source, options.prefix).select("key", "size", "last_modified"),
        options.repeated_keys)
    rows = listing.select(compared, "key", F.col("size").alias("listed_size"))
    if content or metadata:
        s_heads = prefix_filter(source_heads, options.prefix).select(compared, *columns)
        rows = _attach(rows, s_heads, "s", options)
    t_heads = _target_side(target_heads, options).select(
        F.col("key").alias("target_key"), *columns)
    return _attach(rows, t_heads, "t", options)


def _attach(
    rows: DataFrame, table: DataFrame, name: str, options: ValidateOptions
) -> DataFrame:
    """Left join with the (newest) row of each compared key, as one struct column."""
    values = [c for c in table.columns if c != "target_key"]
    current = single(table, options.repeated_keys, "target_key").select(
        "target_key", F.struct(*values).alias(name))
    return rows.join(current, "target_key", "left")


def composite_cases(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame, options: ValidateOptions
) -> DataFrame:
    """Pairs of one length whose ETags differ, one at least being composite:
    ``key, target_key, size, parts, etag, read_source``.

    The body of one side (of the one whose ETag is plain; the source's if neither is) is to be
    digested in so many ``parts``, to see whether it can have the other side's ``etag``.
    """
    s_tag, t_tag = _tags()
    read_source = etag_parts(t_tag).isNotNull()
    wanted = F.when(read_source, t_tag).otherwise(s_tag)
    return _sides(source, source_heads, target_heads, options).filter(
        F.col("t").isNotNull() & F.col("s").isNotNull()
        & F.col("s.content_length").eqNullSafe(F.col("t.content_length")) & _composite_pair()
    ).select(
        "key", "target_key", F.col("s.content_length").alias("size"),
        etag_parts(wanted).alias("parts"), wanted.alias("etag"), read_source.alias("read_source")
    ).dropDuplicates(["key", "target_key"])


def composite_verdicts(cases: DataFrame, source_etags: DataFrame, target_etags: DataFrame) -> DataFrame:
    """``target_key, composite_ok``: whether the ETag looked for is among those the body can have.

    ``source_etags`` and ``target_etags`` are ``key, etags`` of the bodies that were read.
    """
    s_side = source_etags.select(F.col("key"), F.col("etags").alias("s_etags"))
    t_side = target_etags.select(F.col("key").alias("target_key"), F.col("etags").alias("t_etags"))
    seen = F.when(F.col("read_source"), F.col("s_etags")).otherwise(F.col("t_etags"))
    return cases.join(s_side, "key", "left").join(t_side, "target_key", "left").select(
        "target_key", F.coalesce(F.array_contains(seen, F.col("etag")), F.lit(False)).alias("composite_ok"))


def undecided_bodies(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame, options: ValidateOptions,
    composites: DataFrame | None = None,
) -> DataFrame:
    """``key, target_key, size`` of objects only their bodies can tell apart, each once.

    Both sides exist, length and ETag raise no objection, and the size is within the limit, if there is one.
    With ``composites`` (``composite_verdicts``) also those whose composite ETag was not found again.
    """
    rows = _with_composites(_sides(source, source_heads, target_heads, options), composites, options)
    why = content_mismatch(
        F.col("listed_size"), options.digest_limit, False, with_composites=composites is not None)
    open_case = why.isNull()
    if composites is not None:
        ok = F.coalesce(F.col("c.composite_ok"), F.lit(False))
        same_length = F.col("s.content_length").eqNullSafe(F.col("t.content_length"))
        open_case = (open_case & ~ok) | (same_length & _composite_pair() & ~ok)
    return rows.filter(
        F.col("t").isNotNull() & F.col("s").isNotNull() & open_case
        & _within(F.col("listed_size"), options.digest_limit)
    ).select("key", "target_key", F.col("listed_size").alias("size")).dropDuplicates(
        ["key", "target_key"])


def content_check(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame,
    options: ValidateOptions, source_digests: DataFrame | None = None,
    target_digests: DataFrame | None = None, composites: DataFrame | None = None,
) -> DataFrame:
    """``key, match, reason`` for source objects that have a target.

    Without ``composites`` (``composite_verdicts``) a composite ETag is compared like any other.
    """
    rows = _with_digests(
        _sides(source, source_heads, target_heads, options), source_digests, target_digests,
        options,
    )
    rows = _with_composites(rows, composites, options)
    why = content_mismatch(
        F.col("listed_size"), options.digest_limit, source_digests is not None,
        with_composites=composites is not None,
    )
    return rows.filter(F.col("t").isNotNull()).select(
        "key", why.isNull().alias("match"), why.alias("reason")
    )


def _with_digests(
    rows: DataFrame, source_digests: DataFrame | None, target_digests: DataFrame | None,
    options: ValidateOptions,
) -> DataFrame:
    if source_digests is None or target_digests is None:
        return rows
    s_side = prefix_filter(source_digests, options.prefix).select(
        _compared_key(options).alias("target_key"), "md5")
    t_side = _target_side(target_digests, options).select(
        F.col("key").alias("target_key"), "md5")
    return _attach(_attach(rows, s_side, "s_body", options), t_side, "t_body", options)


def _with_composites(
    rows: DataFrame, composites: DataFrame | None, options: ValidateOptions
) -> DataFrame:
    return rows if composites is None else _attach(rows, composites, "c", options)


def metadata_check(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame,
    options: ValidateOptions,
) -> DataFrame:
    """``key, match, differences`` for source objects that have a target."""
    fields = options.metadata_fields or VALIDATE_FIELDS
    return _sides(
        source, source_heads, target_heads, options, content=False, metadata=True
    ).filter(F.col("t").isNotNull()).select("key", metadata_differences(fields).alias("differences")).select(
        "key", all_match("differences").alias("match"), "differences"
    )


def validate(
    source: DataFrame, source_heads: DataFrame, target_heads: DataFrame,
    options: ValidateOptions, source_acls: DataFrame | None = None,
    target_acls: DataFrame | None = None, source_digests: DataFrame | None = None,
    target_digests: DataFrame | None = None, composites: DataFrame | None = None,
) -> DataFrame:
    """``VALIDATION`` rows: three flags, success, and the error texts.

    A missing target fails with all flags null; a check that is off counts as passed where
    the target exists. A head or list that cannot be read fails its check.
    """
    rows = _sides(
        source, source_heads, target_heads, options, options.check_content,
        options.check_metadata)
    present = F.col("t").isNotNull()
    columns: dict[str, Column] = {}
    no_text = F.expr("cast(array() as array<string>)")

    if options.check_content:
        rows = _with_digests(rows, source_digests, target_digests, options)
        rows = _with_composites(rows, composites, options)
        why = content_mismatch(
            F.col("listed_size"), options.digest_limit, source_digests is not None,
            with_composites=composites is not None,
        )
        why = F.when(F.col("s").isNull(), F.lit("source head unreadable")).otherwise(why)
        columns["content_why"] = why
    if options.check_metadata:
        columns["differences"] = metadata_differences(options.metadata_fields or VALIDATE_FIELDS)
    if options.check_acl:
        if source_acls is None or target_acls is None:
            raise ValueError("check_acl needs the ACL tables of both sides")
        rows = _with_acls(rows, source_acls, target_acls, options)
        lists = F.col("s_acl").isNotNull() & F.col("t_acl").isNotNull()
        columns["acl_same"] = lists & (
            F.col("s_acl.owner.id").eqNullSafe(F.col("t_acl.owner.id"))
            & grants_match(F.col("s_acl.grants"), F.col("t_acl.grants"), options.acl_mode)
        )
    rows = rows.withColumns(columns) if columns else rows

    passed = F.lit(True)
    content_ok = F.col("content_why").isNull() if options.check_content else passed
    metadata_ok = (
        F.col("s").isNotNull() & all_match("differences") if options.check_metadata else passed
    )
    acl_ok = F.coalesce(F.col("acl_same"), F.lit(False)) if options.check_acl else passed

    errors = [no_text]
    if options.check_content:
        errors.append(F.array(F.when(
            ~content_ok, F.concat(F.lit("content_mismatch: "), F.col("content_why")))))
    if options.check_metadata:
        wrong = F.transform(
            F.filter("differences", lambda d: ~d["match"]),
            lambda d: F.concat(F.lit("metadata_mismatch: "), d["field"]),
        )
        errors.append(F.when(
            F.col("s").isNull(), F.array(F.lit("metadata_mismatch: unreadable"))).otherwise(wrong))
    if options.check_acl:
        errors.append(F.array(F.when(~acl_ok, F.lit("acl_mismatch"))))
    absent = F.array(F.concat(F.lit("Target object not found: "), F.col("target_key")))
    return rows.select(
        "key",
        F.when(present, F.col("target_key")).alias("target_key"),
        (present & content_ok & metadata_ok & acl_ok).alias("success"),
        F.when(present, content_ok).alias("content_ok"),
        F.when(present, metadata_ok).alias("metadata_ok"),
        F.when(present, acl_ok).alias("acl_ok"),
        F.when(present, F.array_compact(F.concat(*errors))).otherwise(absent).alias("errors"),
    )


def _with_acls(
    rows: DataFrame, source_acls: DataFrame, target_acls: DataFrame, options: ValidateOptions
) -> DataFrame:
    s_side = prefix_filter(source_acls, options.prefix).select(
        _compared_key(options).alias("target_key"), "owner", "grants")
    t_side = _target_side(target_acls, options).select(
        F.col("key").alias("target_key"), "owner", "grants")
    return _attach(_attach(rows, s_side, "s_acl", options), t_side, "t_acl", options)


def validation_errors(validation: DataFrame) -> DataFrame:
    """Failed rows with their error texts."""
    return validation.filter(~F.col("success")).select("key", "errors")


def validation_summary(validation: DataFrame, options: ValidateOptions) -> DataFrame:
    """Total, and passed / failed / skipped per check, as one row."""
    total = F.count("*")

    def passed(flag: str) -> Column:
        return F.count_if(F.coalesce(F.col(flag), F.lit(False)))

    zero = F.lit(0).cast("long")
    columns = [
        total.alias("total_objects"),
        passed("content_ok").alias("content_passed"),
        (total - passed("content_ok")).alias("content_failed"),
    ]
    for check, enabled in (("metadata", options.check_metadata), ("acl", options.check_acl)):
        flag = f"{check}_ok"
        columns += [
            (passed(flag) if enabled else zero).alias(f"{check}_passed"),
            (total - passed(flag) if enabled else zero).alias(f"{check}_failed"),
            (zero if enabled else total).alias(f"{check}_skipped"),
        ]
    return validation.agg(*columns)
