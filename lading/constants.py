"""Limits, labels and names that results depend on."""

# Sizes in bytes.
LARGE_OBJECT_BYTES = 100 * 1024 * 1024
DIGEST_LIMIT_BYTES = 5 * 1024 * 1024
PART_BYTES = 8 * 1024 * 1024

# Row counts.
PAGE_KEYS = 1000
PREVIEW_ROWS = 50
FAILED_ROWS = 100
FAILED_ROWS_IN_TEXT = 10
HISTORY_ROWS = 10

# Widths of the preview columns, in characters.
PREVIEW_KEY_CHARS = 38
PREVIEW_TIME_CHARS = 19

# A part manifest is cut into blocks of this many parts.
MANIFEST_BLOCK_PARTS = 1000

# Parts of one object, and the sizes in MiB that composite ETags are usually made with.
MOST_PARTS = 10_000
USUAL_PART_MIB = (8, 5, 16, 64, 100, 15, 32, 50, 128, 256, 512)

# Object defaults.
DEFAULT_STORAGE_CLASS = "STANDARD"
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")

# Header names in lower case and the field each one becomes.
HEADER_FIELDS = {
    "content-length": "ContentLength",
    "content-type": "ContentType",
    "content-md5": "ContentMD5",
    "last-modified": "LastModified",
    "etag": "ETag",
    "storage-class": "StorageClass",
    "cache-control": "CacheControl",
    "expires": "Expires",
}
USER_HEADER_PREFIX = "x-amz-meta-"

# Head fields and the HEAD column that holds each one.
FIELD_COLUMNS = {
    "ContentLength": "content_length",
    "ContentType": "content_type",
    "ContentMD5": "content_md5",
    "LastModified": "last_modified",
    "ETag": "etag",
    "StorageClass": "storage_class",
    "CacheControl": "cache_control",
    "Expires": "expires",
}
USER_METADATA_FIELD = "Metadata"
COMPARE_FIELDS = (
    "ContentType", "ContentLength", "ContentMD5", "CacheControl", "Expires", "Metadata",
)
VALIDATE_FIELDS = ("ContentType", "ContentLength", "CacheControl", "Expires", "Metadata")

# Access control.
PERMISSIONS = ("READ", "WRITE", "READ_ACP", "WRITE_ACP", "FULL_CONTROL")
ALL_USERS = "https://acs.amazonaws.com/groups/global/AllUsers"
AUTHENTICATED_USERS = "https://acs.amazonaws.com/groups/global/AuthenticatedUsers"
ALL_USERS_HTTP = "http://acs.amazonaws.com/groups/global/AllUsers"

# Run states.
COMPLETED = "completed"
COMPLETED_WITH_ERRORS = "completed_with_errors"
CANCELLED = "cancelled"
PENDING = "pending"
RUNNING = "running"
FAILED = "failed"

# Reasons on result rows.
DRY_RUN_UPLOAD = "[DRY-RUN] Would upload"
DRY_RUN_DELETE = "[DRY-RUN] Would delete"
FILTERED = "filtered"
