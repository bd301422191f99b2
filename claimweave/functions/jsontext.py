"""Tolerant reading of JSON that arrives inside other text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimweave.functions.text import strip_ws


def strip_fences(c: Column) -> Column:
    """Remove an opening and a closing Markdown code fence."""
    text = strip_ws(c)
    text = F.regexp_replace(text, r"(?i)^```json\s*", "")
    text = F.regexp_replace(text, r"^```\s*", "")
    return strip_ws(F.regexp_replace(text, r"\s*```$", ""))


def _is_json(text: Column) -> Column:
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))


def extract_json(c: Column) -> Column:
    """The JSON text of a reply, else from its first ``{`` to its last ``}``, else null."""
    whole = strip_fences(c)
    inner = F.regexp_extract(whole, r"(?s)\{.*\}", 0)
    return F.when(_is_json(whole), whole).when((inner != "") & _is_json(inner), inner)


def is_json_object(json_text: Column) -> Column:
    """Whether a valid JSON text is an object."""
    return F.coalesce(json_text.rlike(r"^\s*\{"), F.lit(False))


def to_json_array(c: Column) -> Column:
    """Array of strings as a JSON list; null as an empty list."""
    return F.to_json(F.coalesce(c, F.array().cast("array<string>")))
