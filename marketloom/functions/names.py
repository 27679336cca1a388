"""Lists of names that were stored as lists, as JSON text, or as JSON text inside lists."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _leaves(value) -> Iterator[str]:
    """The texts in a value, however deep they are nested, in order; text that only looks like a list is a name."""
    stack = [value]
    while stack:
        v = stack.pop()
        if v is None or (isinstance(v, float) and v != v):
            continue
        if isinstance(v, (list, tuple)):
            stack.extend(reversed(v))
            continue
        text = str(v).strip()
        if text.startswith("["):
            try:
                inner = json.loads(text)
            except (ValueError, RecursionError):
                inner = None
            if isinstance(inner, list):
                stack.append(inner)
                continue
        if text:
            yield text


def names_of(value) -> list[str]:
    """Distinct names regardless of case, each as it was first written."""
    first: dict[str, str] = {}
    for name in _leaves(value):
        first.setdefault(name.lower(), name)
    return list(first.values())


def flat_names(text: Column) -> Column:
    """names_of of a text column; null and blank give the empty list. Arrow-batched, as the nesting has no fixed depth."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(names_of)

    return run(text)


def flat_names_of_list(names: Column) -> Column:
    """names_of of an array column whose items may be lists as text."""
    return flat_names(F.to_json(names))
