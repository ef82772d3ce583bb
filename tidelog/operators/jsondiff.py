"""JSON diffs of partial updates applied to documents."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = re.compile(r'\.(?:"((?:[^"\\]|\\.)*)"|([^.\[\]"]+))|\[(\d+)\]')


class Number(str):
    """A JSON number with a fraction or exponent, kept as it is written."""


def parsed(text: str):
    return json.loads(text, parse_float=Number)


def shown(value) -> str:
    """Compact JSON with sorted keys."""
    if isinstance(value, Number):
        return str(value)
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k, ensure_ascii=False)}:{shown(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(shown, value)) + "]"
    return json.dumps(value, ensure_ascii=False)


def path_steps(path: str) -> list[str | int]:
    """``$.a."b c"[2]`` to ['a', 'b c', 2]."""
    if not path.startswith("$"):
        raise ValueError(f"bad JSON path {path}")
    steps, at = [], 1
    while at < len(path):
        found = STEP.match(path, at)
        if not found:
            raise ValueError(f"bad JSON path {path}")
        quoted, name, index = found.groups()
        steps.append(int(index) if index is not None else json.loads(f'"{quoted}"') if quoted is not None else name)
        at = found.end()
    return steps


def apply_one(doc, op: str, path: str, value: str | None):
    steps = path_steps(path)
    if not steps:
        return parsed(value) if op != "remove" else None
    parent = doc
    for step in steps[:-1]:
        parent = parent[step]
    last = steps[-1]
    if op == "remove":
        del parent[last]
    elif op == "insert" and isinstance(parent, list):
        parent.insert(last, parsed(value))
    elif op == "replace" and isinstance(parent, dict) and last not in parent:
        raise KeyError(last)
    else:
        parent[last] = parsed(value)
    return doc


def apply_json_diffs(docs: DataFrame, doc_col: str, diffs_col: str) -> DataFrame:
    """Documents after their diffs (``array<struct<op,path,value>>``, in order).

    A diff that does not fit its document gives NULL and a reason in ``diff_error``.
    """

    @F.pandas_udf("doc string, diff_error string")
    def patched(doc: pd.Series, diffs: pd.Series) -> pd.DataFrame:
        out = []
        for text, changes in zip(doc, diffs):
            try:
                value = parsed(text)
                for d in [] if changes is None else changes:
                    value = apply_one(value, d["op"], d["path"], d["value"])
                out.append((shown(value), None))
            except (ValueError, KeyError, IndexError, TypeError) as exc:
                out.append((None, f"{type(exc).__name__}: {exc}"))
        return pd.DataFrame(out, columns=["doc", "diff_error"])

    applied = docs.withColumn("__p", patched(F.col(doc_col), F.col(diffs_col)))
    return applied.withColumns({doc_col: F.col("__p.doc"), "diff_error": F.col("__p.diff_error")}).drop("__p")
