"""Text functions on names, typed text values and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words read as booleans, and the number spellings.
TRUE_WORDS = ["true", "1", "yes", "y"]
FALSE_WORDS = ["false", "0", "no", "n"]
INT_PATTERN = r"^[+-]?[0-9]+$"
NUMBER_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def norm(text: Column) -> Column:
    """Trimmed lower case."""
    return F.lower(F.trim(text))


def sanitize_name(name: Column) -> Column:
    """Folder-safe name; word characters are Unicode letters, digits and ``_``."""
    # The patterns, since folder names must match.
    joined = F.regexp_replace(norm(name), r"(?U)[\s\-()]+", "_")
    words = F.regexp_replace(joined, r"(?U)[^\w]", "")
    return F.trim(F.regexp_replace(words, "_+", "_"), F.lit("_"))


def slugify(text: Column) -> Column:
    """Identifier of a collection; ``collection`` when nothing is left."""
    slug = F.trim(F.regexp_replace(norm(text), r"[^\p{L}\p{N}]+", "_"), F.lit("_"))
    return F.when(slug != "", slug).otherwise(F.lit("collection"))


def display_name(dataset_id: Column) -> Column:
    return F.initcap(F.replace(dataset_id, F.lit("_"), F.lit(" ")))


def to_number(text: Column) -> Column:
    """Number of a text, NULL when it is none (``5d`` and ``nan`` are none)."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(NUMBER_PATTERN), trimmed.try_cast("double"))


def to_bool(text: Column) -> Column:
    word = norm(text)
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def unquote(text: Column) -> Column:
    """Trimmed text without one pair of equal outer quotes."""
    trimmed = F.trim(text)
    return F.regexp_replace(trimmed, r"(?s)^(?:\"(.*)\"|'(.*)')$", "$1$2")


def utc_stamp() -> Column:
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
