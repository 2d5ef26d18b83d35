"""File-name predicates, shard keys, output paths, outcome classes, retry delays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed patterns and names.
TARGET_FILE = r"^wgs\.[A-Z0-9]+(?:\.\d+)?\.fsa_nt\.gz$"
SHARD_DIRECTORY = r"^(?:[A-Z]/|[A-Z0-9]{3}/)$"
HREF = r'(?i)href="([^"]+)"'
FALLBACK_SHARD = "misc"
ARCHIVE_SUFFIX = ".sig.zip"
MEMBER_SUFFIX = ".sig.gz"
MEMBER_FOLDER = "signatures/"
NOT_FOUND = "HTTP 404"
ERROR_LENGTH = 500
LONGEST_DELAY = 300


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def is_target_file(path: Column | str, pattern: str = TARGET_FILE) -> Column:
    """Does the base name match, from its start?"""
    return base_name(path).rlike(f"^(?:{pattern})")


def is_signature_member(name: Column | str, root_only: bool = False) -> Column:
    """Is this archive member a signature: in a signatures folder, gzip-compressed?"""
    n = _col(name)
    place = n.startswith(MEMBER_FOLDER)
    if not root_only:
        place = place | n.contains("/" + MEMBER_FOLDER)
    return n.endswith(MEMBER_SUFFIX) & place


def shard_of(path: Column | str) -> Column:
    """First three characters after ``wgs.``, up to the next dot."""
    b = base_name(path)
    token = F.substring(F.split_part(F.substring(b, F.lit(5), F.length(b)), F.lit("."), F.lit(1)), 1, 3)
    return F.when(b.startswith("wgs."), F.coalesce(F.nullif(token, F.lit("")), F.lit(FALLBACK_SHARD))
                  ).otherwise(FALLBACK_SHARD)


def shard_folder(subdir: Column | str, filename: Column | str) -> Column:
    """The listed sub-directory where there is one, else the shard of the name."""
    return F.coalesce(F.nullif(_col(subdir), F.lit("")), shard_of(filename))


def output_path(root: str, subdir: Column | str, filename: Column | str) -> Column:
    return F.concat_ws("/", F.lit(root), shard_folder(subdir, filename),
                       F.concat(_col(filename), F.lit(ARCHIVE_SUFFIX)))


def download_path(root: str, subdir: Column | str, filename: Column | str) -> Column:
    return F.concat_ws("/", F.lit(root), shard_folder(subdir, filename), _col(filename))


def failure_status(message: Column | str) -> Column:
    """A missing file is gone for good; anything else may be tried again."""
    return F.when(_col(message).contains(NOT_FOUND), "GONE").otherwise("ERROR")


def short_error(message: Column | str) -> Column:
    return F.substring(_col(message), 1, ERROR_LENGTH)


def retry_delay(tries: Column | str) -> Column:
    """min(300, 2^tries) seconds; 2^9 already exceeds the ceiling."""
    return F.least(F.lit(LONGEST_DELAY), F.pow(F.lit(2.0), F.least(_col(tries), F.lit(9))).cast("int"))


def href_kind(href: Column | str) -> Column:
    """'dir', 'file' or NULL for a link of a listing page."""
    h = _col(href)
    return (F.when(h.isin("../", "./"), F.lit(None).cast("string"))
            .when(h.rlike(SHARD_DIRECTORY), "dir")
            .when(h.endswith(".gz"), "file"))
