"""Column expressions of the record and plan model."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column
from pyspark.sql import functions as F


def identity(revision: str | Column, path: Column, *offsets: Column) -> Column:
    """revision:path:offset[:offset], the same whatever order a plan has."""
    revision = F.lit(revision) if isinstance(revision, str) else revision
    return F.concat_ws(":", revision, path, *(o.cast("string") for o in offsets))


def order_hash(seed: str, item: Column) -> Column:
    """Hex SHA-256 of seed, a zero byte and the item's identity; hex order is digest order."""
    return F.sha2(F.concat(F.lit(seed), F.char(F.lit(0)), item), 256)


def without_cr(value: Column) -> Column:
    """value without one trailing carriage return."""
    return F.regexp_replace(value, r"\r\z", "")


def in_root(path: Column, glob: str) -> Column:
    """Case-sensitive fnmatch of a path that has no folder."""
    pattern = fnmatch.translate(glob)
    for python, java in (("\\Z", "\\z"), ("(?s:", "(?s:")):
        pattern = pattern.replace(python, java)
    return ~F.contains(path, F.lit("/")) & path.rlike("\\A" + pattern)


def accepted(cluster: Column, clusters) -> Column:
    return cluster.isin(*clusters)
