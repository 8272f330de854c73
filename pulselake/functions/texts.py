"""Lists that arrive as text, and the Hive date parts of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_quoted_list(text: Column) -> Column:
    """``['back', 'core']`` to an array; null where the text is not a quoted list."""
    return F.from_json(F.translate(text, "'", '"'), "array<string>")


def parse_bare_list(text: Column) -> Column:
    """``[back, core]`` to an array; an empty list gives one empty element."""
    return F.split(F.translate(text, "[]", ""), ", ")


def parse_groups(text: Column) -> Column:
    """Either spelling to an array without empty elements, null for null."""
    items = F.split(F.translate(text, "[]'\"", ""), ",")
    return F.filter(F.transform(items, lambda item: F.trim(item)), lambda item: item != "")


def date_parts(ts: Column) -> dict[str, Column]:
    """Hive partition values taken from each row's own timestamp."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }
