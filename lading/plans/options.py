"""Options of a run. They describe the work; no data is kept in them."""

from __future__ import annotations

from dataclasses import dataclass

from ..constants import LARGE_OBJECT_BYTES


@dataclass(frozen=True)
class SyncOptions:
    """``since`` is UTC text. ``repeated_keys``: the inventories may hold several rows of one key
    (feeds, versioned listings), of which the newest counts; False saves that step. Objects longer
    than ``split_bytes`` are copied by their parts, each by many tasks (None: none are)."""

    source_bucket: str = ""
    target_bucket: str = ""
    source_prefix: str = ""
    target_prefix: str = ""
    since: str | None = None
    since_last_sync: bool = False
    delete: bool = False
    part_size: int = 8
    storage_class: str | None = None
    preserve_metadata: bool = False
    preserve_acl: bool = False
    exclude_patterns: tuple[str, ...] = ()
    include_patterns: tuple[str, ...] = ()
    dry_run: bool = False
    allow_empty_source: bool = False
    repeated_keys: bool = True
    split_bytes: int | None = LARGE_OBJECT_BYTES

    @property
    def part_bytes(self) -> int:
        """``part_size`` is given in MiB."""
        return self.part_size * 1024 * 1024


@dataclass(frozen=True)
class ValidateOptions:
    """``digest_limit``: bodies longer than that many bytes are not read where ETags decide
    nothing, and count as equal by length (``DIGEST_LIMIT_BYTES`` is a usual choice). By default
    bodies of any length are read; digests stream. ``etag_part_unit``: the bytes of which the part
    sizes behind composite ETags are taken to be multiples."""

    source_bucket: str = ""
    target_bucket: str = ""
    prefix: str = ""
    target_prefix: str | None = None
    check_content: bool = True
    check_metadata: bool = True
    check_acl: bool = True
    metadata_fields: tuple[str, ...] | None = None
    acl_mode: str = "reference"
    repeated_keys: bool = True
    digest_limit: int | None = None
    etag_part_unit: int = 1024 * 1024
