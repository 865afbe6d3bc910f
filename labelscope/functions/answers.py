"""Prompt, cache-key and answer expressions for batch labelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelscope.functions.text import strip

UNKNOWN = "unknown"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def json_text(value: Column) -> Column:
    """One JSON string literal, quotes included."""
    wrapped = F.to_json(F.array(value))
    return F.substr(wrapped, F.lit(2), F.length(wrapped) - 2)


def prompt_cache_key(
    messages: Column, model: str, temperature: float, max_tokens: int, extra: str = "{}"
) -> Column:
    """SHA-256 over the canonical JSON (sorted keys, ", " and ": ") of a request.

    ``extra`` is the canonical JSON text of further request fields.
    """
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit('{"content": '), json_text(m["content"]),
            F.lit(', "role": '), json_text(m["role"]), F.lit("}"),
        ),
    )
    blob = F.concat(
        F.lit(f'{{"extra": {extra}, "max_tokens": {int(max_tokens)}, "messages": ['),
        F.array_join(turns, ", "),
        F.lit('], "model": '), json_text(F.lit(model)),
        F.lit(f', "temperature": {float(temperature)}}}'),
    )
    return F.sha2(blob, 256)


def parse_label(raw: Column, labels: list[str]) -> Column:
    """Exact label (any case), else the longest label inside the answer, else ``unknown``."""
    text = F.lower(strip(raw))
    exact = F.create_map(
        *[F.lit(x) for low, label in {v.lower(): v for v in labels}.items() for x in (low, label)]
    )
    longest_first = sorted(labels, key=len, reverse=True)
    contained = [F.when(text.contains(v.lower()), F.lit(v)) for v in longest_first]
    return F.coalesce(exact[text], *contained, F.lit(UNKNOWN))
