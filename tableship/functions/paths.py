"""Path columns: names inside a dataset, base names and version stamps."""

from __future__ import annotations

import os
import posixpath
import re
from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The form of a version directory and the text for a path without one.
VERSION_FORMAT = "%Y%m%d_%H%M%S"
VERSION_PATTERN = r"(\d{8}_\d{6})"
NO_VERSION = "unknown"

#: Versions made here go on with microseconds, so that two runs in one second differ.
_STAMP = r"\d{8}_\d{6}(?:_\d{6})?"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"


def new_version() -> str:
    """The time in UTC."""
    return datetime.now(UTC).strftime(VERSION_FORMAT + "_%f")


def version_of(path: str) -> str:
    """The last version stamp in a path, else ``unknown``."""
    return (re.findall(_STAMP, path) or [NO_VERSION])[-1]


def dataset_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/{version}"


def plain_path(path: str) -> str:
    """Absolute path without scheme, authority, trailing or double slashes, ``.`` and ``..``."""
    bare = re.sub(_SCHEME, "", path)
    if bare == path and not path.startswith("/"):
        bare = os.path.abspath(path)
    return posixpath.normpath("/" + bare.lstrip("/"))


def store_of(path: str, default: str = "file") -> str:
    """Scheme and authority of a path; ``default`` (the default file system) for a bare one."""
    found = re.match(r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/]*))?", path)
    if not found:
        return store_of(default + ":", "") if ":" not in default else store_of(default, "")
    return f"{found[1].lower()}://{(found[2] or '').lower()}"


def inside(path: str, folder: str, default: str = "file") -> bool:
    """Whether ``path`` is ``folder`` or below it, in the same store."""
    if store_of(path, default) != store_of(folder, default):
        return False
    return (plain_path(path).rstrip("/") + "/").startswith(plain_path(folder).rstrip("/") + "/")


def default_store(spark) -> str:
    """The file system of paths without a scheme."""
    return spark.conf.get("spark.hadoop.fs.defaultFS", None) or "file"


def plain_name(path: Column) -> Column:
    """A path column without scheme and authority."""
    return F.regexp_replace(path, _SCHEME, "")


def relative_path(path: Column, root: str) -> Column:
    """Path below ``root``, whatever scheme the listing puts in front of it; the base name
    where ``root`` is the file itself."""
    if re.search(r"[*?\[{]", root):
        raise ValueError(f"{root} is a pattern, not a folder")
    base = plain_path(root).rstrip("/")
    plain = plain_name(path)
    below = F.substring(plain, len(base) + 2, 2**31 - 1)
    wrong = F.raise_error(F.concat(plain, F.lit(f" is not below {base}"))).cast("string")
    return (
        F.when(plain == base, file_name(path))
        .when(F.startswith(plain, F.lit(base + "/")), below)
        .when(plain.isNotNull(), wrong)
    )


def decoded_path(name: str) -> Column:
    """Plain form of a percent-encoded path, in which a plus sign is just itself."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def path_version(path: Column) -> Column:
    """Version stamp found in a path, else ``unknown``."""
    found = F.regexp_extract(path, rf".*?({_STAMP})", 1)
    return F.coalesce(F.nullif(found, F.lit("")), F.lit(NO_VERSION))


def megabytes_of(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)
