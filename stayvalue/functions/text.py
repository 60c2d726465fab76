"""Repair of text that was UTF-8 but has been decoded as Latin-1 (``BÃ©arn`` -> ``Béarn``)."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The well-formed UTF-8 byte sequences (Unicode standard, table 3-7),
# written over the Latin-1 characters that stand for those bytes.
_WELL_FORMED = "|".join(
    (
        r"[\x00-\x7F]++",
        r"[\xC2-\xDF][\x80-\xBF]",
        r"\xE0[\xA0-\xBF][\x80-\xBF]",
        r"[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}",
        r"\xED[\x80-\x9F][\x80-\xBF]",
        r"\xF0[\x90-\xBF][\x80-\xBF]{2}",
        r"[\xF1-\xF3][\x80-\xBF]{3}",
        r"\xF4[\x80-\x8F][\x80-\xBF]{2}",
    )
)
_NOT_LATIN1 = r"[^\x{00}-\x{FF}]"
_MULTI_BYTE = r"[\xC2-\xF4][\x80-\xBF]"


def repair_text(text: Column, mode: Literal["detect", "always"] = "detect") -> Column:
    """Re-read Latin-1 characters as UTF-8 bytes; NULL stays NULL.

    ``always`` drops every character that cannot take part, so it also damages text that was
    right to begin with. ``detect`` changes a value only if nothing is lost by the re-reading
    and at least one multi-byte sequence is present.
    """
    if mode not in ("detect", "always"):
        raise ValueError(f"mode must be 'detect' or 'always', not {mode!r}")
    latin1 = F.regexp_replace(text, _NOT_LATIN1, "")
    # Keeps each well-formed sequence and drops any other character. One sequence per match:
    # a repeated group would recurse once per character on long texts.
    kept = F.regexp_replace(latin1, f"(?s)({_WELL_FORMED})|.", "$1")
    repaired = F.encode(kept, "ISO-8859-1").cast("string")
    if mode == "always":
        return repaired
    return F.when(text.rlike(_MULTI_BYTE) & (kept == text), repaired).otherwise(text)


def misread_text(text: Column) -> Column:
    """The damage that :func:`repair_text` undoes: UTF-8 bytes decoded as Latin-1."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
