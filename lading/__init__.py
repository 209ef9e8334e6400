"""Object inventories on Spark: listing, mirroring, validation and run history."""

from .jobs.objects import (
    copy_object, copy_objects, delete_objects, digest_objects, list_objects,
)
from .jobs.runs import run_sync, run_validation
from .plans.options import SyncOptions, ValidateOptions
from .plans.sync import dry_run_plan, mirror_plan, sync_plan, sync_summary
from .plans.validate import validate, validation_summary
from .sources.inventory import (
    inventory_normalize, inventory_scan, latest_per_key, list_page, listing_scan, page_summary,
    tree_inventory,
)
from .streaming.incremental import incremental_sync_stream

__all__ = [
    "SyncOptions", "ValidateOptions", "copy_object", "copy_objects", "delete_objects",
    "digest_objects", "dry_run_plan", "incremental_sync_stream", "inventory_normalize",
    "inventory_scan", "latest_per_key", "list_objects", "list_page", "listing_scan", "mirror_plan",
    "page_summary", "run_sync", "run_validation", "sync_plan", "sync_summary", "tree_inventory",
    "validate", "validation_summary",
]
