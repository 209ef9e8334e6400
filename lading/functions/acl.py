"""Expressions on one access-control list."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import ALL_USERS, ALL_USERS_HTTP, AUTHENTICATED_USERS, PERMISSIONS
from ..schemas import GRANT
from .keys import _col

_GRANTS_TYPE = f"array<{GRANT.simpleString()}>"


def no_grants() -> Column:
    return F.expr(f"cast(array() as {_GRANTS_TYPE})")


def make_grant(
    kind: Column | None = None, permission: Column | None = None, id: Column | None = None,
    display_name: Column | None = None, uri: Column | None = None,
    email_address: Column | None = None,
) -> Column:
    def text(value: Column | None) -> Column:
        return (F.lit(None) if value is None else value).cast("string")

    return F.struct(
        F.struct(
            text(kind).alias("type"), text(id).alias("id"),
            text(display_name).alias("display_name"), text(uri).alias("uri"),
            text(email_address).alias("email_address"),
        ).alias("grantee"),
        text(permission).alias("permission"),
    )


def grantee_label(grantee: Column) -> Column:
    uri = grantee["uri"]
    return (
        F.when(uri.endswith("AllUsers"), F.lit("AllUsers (public)"))
        .when(uri.endswith("AuthenticatedUsers"), F.lit("AuthenticatedUsers"))
        .when(uri != "", uri)
        .otherwise(F.coalesce(grantee["display_name"], grantee["id"], F.lit("N/A")))
    )


def acl_format(owner: Column | str, grants: Column | str) -> Column:
    """Owner line and one line per grant."""
    owner = _col(owner)
    first = F.concat(
        F.lit("Owner: "), F.coalesce(owner["id"], F.lit("N/A")), F.lit(" ("),
        F.coalesce(owner["display_name"], F.lit("N/A")), F.lit(")"),
    )

    def line(grant: Column) -> Column:
        who = grant["grantee"]
        named = F.concat(
            who["id"], F.lit(" ("), F.coalesce(who["display_name"], F.lit("")), F.lit(")")
        )
        shown = F.when(who["uri"] != "", who["uri"]).when(who["id"] != "", named)
        return F.concat(
            F.lit("  "), F.coalesce(grant["permission"], F.lit("")), F.lit(": "),
            F.coalesce(shown, F.lit("Unknown")),
        )

    return F.array_join(F.concat(F.array(first), F.transform(_col(grants), line)), "\n")


def _flagged(grants: list[tuple[Column | bool, Column]]) -> Column:
    marked = [
        F.when(flag if isinstance(flag, Column) else F.lit(bool(flag)), grant)
        for flag, grant in grants
    ]
    return F.array_compact(F.array(*marked))


def acl_build(
    grants: Column | str | None = None,
    grant_read: Column | bool = False,
    grant_write: Column | bool = False,
    grant_full_control: Column | bool = False,
    grant_read_acp: Column | bool = False,
    grant_write_acp: Column | bool = False,
) -> Column:
    """Explicit grants, then the group grants the flags ask for, in fixed order."""
    everyone, signed_in, group = F.lit(ALL_USERS), F.lit(AUTHENTICATED_USERS), F.lit("Group")
    implied = _flagged([
        (grant_read, make_grant(group, F.lit("READ"), uri=everyone)),
        (grant_write, make_grant(group, F.lit("WRITE"), uri=everyone)),
        (grant_full_control, make_grant(group, F.lit("FULL_CONTROL"), uri=everyone)),
        (grant_read_acp, make_grant(group, F.lit("READ_ACP"), uri=signed_in)),
        (grant_write_acp, make_grant(group, F.lit("WRITE_ACP"), uri=signed_in)),
    ])
    if grants is None:
        return implied
    return F.concat(F.coalesce(_col(grants), no_grants()), implied)


def acl_build_basic(
    grant_read: Column | bool = False, grant_full_control: Column | bool = False
) -> Column:
    """The reduced form: two flags, the short type name and the plain-http group."""
    everyone, kind = F.lit(ALL_USERS_HTTP), F.lit("uri")
    return _flagged([
        (grant_read, make_grant(kind, F.lit("READ"), uri=everyone)),
        (grant_full_control, make_grant(kind, F.lit("FULL_CONTROL"), uri=everyone)),
    ])


def owner_build(owner_id: str | None = None, display_name: str | None = None) -> Column:
    """Owner struct; a display name counts only together with an id."""
    return F.struct(
        F.lit(owner_id or None).cast("string").alias("id"),
        F.lit((display_name or None) if owner_id else None).cast("string").alias("display_name"),
    )


def acl_copy_grants(grants: Column | str) -> Column:
    """The grants that can be given to a copy.

    Known permissions only; a user needs an id, a group a URI, and the id of a grantee by
    e-mail becomes the address.
    """

    def usable(grant: Column) -> Column:
        who = grant["grantee"]
        user = who["type"].isin("CanonicalUser", "AmazonCustomerByEmail") & (who["id"] != "")
        group = (who["type"] == "Group") & (who["uri"] != "")
        return F.coalesce(grant["permission"].isin(*PERMISSIONS) & (user | group), F.lit(False))

    def carried(grant: Column) -> Column:
        who, permission = grant["grantee"], grant["permission"]
        kind = who["type"]
        return (
            F.when(kind == "CanonicalUser", make_grant(
                kind, permission, id=who["id"], display_name=who["display_name"]))
            .when(kind == "Group", make_grant(kind, permission, uri=who["uri"]))
            .otherwise(make_grant(kind, permission, email_address=who["id"]))
        )

    return F.transform(F.filter(_col(grants), usable), carried)


def acl_copy_owner(owner: Column | str) -> Column:
    owner = _col(owner)
    return F.struct(
        F.coalesce(owner["id"], F.lit("")).alias("id"),
        F.coalesce(owner["display_name"], F.lit("")).alias("display_name"),
    )


def grants_match(left: Column, right: Column, mode: str = "reference") -> Column:
    """Whether two grant arrays agree.

    ``reference``: same number, and after a stable sort by (URI, permission) each pair has the
    same permission and not both another URI and another id. ``strict``: the same multiset of
    (type, URI or id, permission).
    """
    def listed(grants: Column) -> Column:
        return F.coalesce(grants, no_grants())

    if mode == "strict":
        def bag(grants: Column) -> Column:
            return F.array_sort(F.transform(listed(grants), lambda g: F.struct(
                g["grantee"]["type"].alias("type"),
                F.coalesce(g["grantee"]["uri"], g["grantee"]["id"]).alias("who"),
                g["permission"].alias("permission"),
            )))

        return bag(left).eqNullSafe(bag(right))
    if mode != "reference":
        raise ValueError(f"unknown mode {mode!r}")

    def ordered(grants: Column) -> Column:
        return F.array_sort(F.transform(listed(grants), lambda g, at: F.struct(
            F.coalesce(g["grantee"]["uri"], F.lit("")).alias("sort_uri"),
            F.coalesce(g["permission"], F.lit("")).alias("permission"),
            at.alias("at"),
            g["grantee"]["uri"].alias("uri"),
            g["grantee"]["id"].alias("id"),
        )))

    pairs = F.zip_with(ordered(left), ordered(right), lambda a, b: (
        a["permission"].eqNullSafe(b["permission"])
        & (a["uri"].eqNullSafe(b["uri"]) | a["id"].eqNullSafe(b["id"]))
    ))
    return (F.size(listed(left)) == F.size(listed(right))) & F.forall(pairs, lambda same: same)
