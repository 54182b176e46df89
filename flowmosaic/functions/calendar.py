"""Slot keys, dates and weekend labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode_key(key: Column) -> Column:
    """Bytes of a slot key -> text."""
    return F.decode(key, "UTF-8")


def encode_key(date: Column, slot: Column, slots: int = 48) -> Column:
    """Inverse of parsing: date and slot -> ``yyyyMMddss`` text, the slot as wide as the largest of the day.

    A slot with more digits than that is written whole, never shortened.
    """
    text = slot.cast("string")
    width = F.greatest(F.length(text), F.lit(len(str(slots))))
    return F.concat(date_text(date), F.lpad(text, width, F.lit("0")))


def key_date(key: Column) -> Column:
    """First eight characters of a slot key as a date."""
    return F.to_date(F.substring(key, 1, 8), "yyyyMMdd")


def key_slot(key: Column) -> Column:
    """Characters after the eighth of a slot key as an integer."""
    return F.substring(key, 9, 8).cast("int")


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyyMMdd")


def is_weekend(date: Column) -> Column:
    """Saturday or Sunday; ``weekday`` counts from Monday = 0."""
    return F.weekday(date) >= 5


def weekend_label(date: Column) -> Column:
    """1 for weekend, 0 for weekday."""
    return is_weekend(date).cast("int")


def label_onehot(label: Column) -> Column:
    """1 -> [1, 0] (weekend), 0 -> [0, 1] (weekday)."""
    return F.when(label == 1, F.array(F.lit(1), F.lit(0))).when(
        label == 0, F.array(F.lit(0), F.lit(1))
    )


def label_scalar(onehot: Column) -> Column:
    """Element 0 of the one-hot pair, i.e. the weekend flag."""
    return F.element_at(onehot, 1)
