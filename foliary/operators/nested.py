"""Texts of nested document elements; nesting has no bound, so this walks in Python, Arrow batch by batch."""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def texts(children: object) -> list[str]:
    """Texts of a list of elements, depth first; groups and shapes are opened."""
    out: list[str] = []
    stack = list(reversed(children)) if isinstance(children, list) else []
    while stack:
        e = stack.pop()
        if not isinstance(e, dict):
            continue
        if isinstance(e.get("children"), list):
            stack.extend(reversed(e["children"]))
        elif isinstance(e.get("text"), str) and e["text"].strip():
            out.append(e["text"].strip())
    return out


def _read(function: Callable[[object], list[str]], text: str | None) -> list[str]:
    """The function's strings for a JSON text; none for null, for what is no JSON and beyond the JSON reader's own depth."""
    try:
        return function(json.loads(text)) if text else []
    except (ValueError, RecursionError):
        return []


def _of_json(function: Callable[[object], list[str]], value: Column) -> Column:
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: _read(function, text))

    return run(value)


def texts_of_json(children: Column) -> Column:
    return _of_json(texts, children)


def texts_of_each(children: Column) -> Column:
    """For each JSON text of an array its texts."""

    @F.pandas_udf("array<array<string>>")
    def run(lists: pd.Series) -> pd.Series:
        return lists.map(lambda many: [_read(texts, x) for x in many] if many is not None else None)

    return run(children)


def files(result: object) -> list[str]:
    """Addresses of output files in a result tree, in document order.

    A list that begins with a string is one file, whose address is that string; else lists and
    objects are opened. ``downloadUrl`` counts too. Only http and https addresses are files.
    """
    out: list[str] = []
    stack: list[object] = [result]
    while stack:
        node = stack.pop()
        if isinstance(node, str):
            out.append(node)
        elif isinstance(node, list):
            stack.extend(node[:1] if node and isinstance(node[0], str) else [x for x in reversed(node) if isinstance(x, (list, dict))])
        elif isinstance(node, dict):
            stack.extend(v for k, v in reversed(node.items()) if isinstance(v, (list, dict)) or (k == "downloadUrl" and isinstance(v, str)))
    return [u for u in out if u.startswith(("http://", "https://"))]


def files_of_json(result: Column) -> Column:
    return _of_json(files, result)
