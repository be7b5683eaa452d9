"""Packed identifiers: fragment tags and ids of replicated halos."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A fragment's tag is -(fragment << 48 | tag); a replicated id is (replication << 41) + tag.
FRAGMENT_BITS, REPLICATION_BITS = 48, 41
TAG_MASK = 2**FRAGMENT_BITS - 1


def parent_tag(tag: Column) -> Column:
    """The tag without its fragment index; a tag that isn't negative is its own."""
    return F.when(tag < 0, (-tag).bitwiseAND(F.lit(TAG_MASK))).otherwise(tag)


def fragment_index(tag: Column) -> Column:
    """The fragment index of a packed tag, 0 for a tag that isn't negative, null for none."""
    return F.when(tag < 0, F.shiftright(-tag, FRAGMENT_BITS)).when(tag >= 0, F.lit(0)).cast("long")


def unique_id(replication: Column, tag: Column) -> Column:
    """(replication << 41) + tag."""
    return F.shiftleft(replication.cast("long"), REPLICATION_BITS) + tag
