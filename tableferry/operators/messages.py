"""Choosing messages to purge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: how many leading characters of a message are looked at.
HEAD_LENGTH = 50


def message_head(text: Column) -> Column:
    """Start of a message; a missing text is empty."""
    return F.substring(F.coalesce(text, F.lit("")), 1, HEAD_LENGTH)


def is_purgeable(text: Column, phrases: Sequence[str]) -> Column:
    """Whether the start of a message contains any of the phrases."""
    head = message_head(text)
    hits = [F.contains(head, F.lit(phrase)) for phrase in phrases]
    return reduce(Column.__or__, hits, F.lit(False))


def select_purgeable(
    messages: DataFrame, phrases: Sequence[str], text: str = "text"
) -> DataFrame:
    """Messages to purge."""
    return messages.filter(is_purgeable(F.col(text), phrases))


def purge_counts(messages: DataFrame, phrases: Sequence[str], text: str = "text") -> DataFrame:
    """One row: messages found and messages to purge."""
    return messages.agg(
        F.count(F.lit(1)).alias("messages"),
        F.count_if(is_purgeable(F.col(text), phrases)).alias("purged"),
    )
