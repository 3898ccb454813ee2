"""Typed signature of a model: what goes in and what comes out.

A signature is a plain document (names, types, nullability) that is taken
from the training data, stored with the model and with its training run, and
enforced whenever the model is applied: one error names every column that is
missing (with what it may have been renamed to), of another type, or nullable
where the model has only seen values.

Defined cases: columns that the model does not use are ignored; the order of
columns has no meaning; a model without a signature accepts anything.
"""

from __future__ import annotations

import difflib

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _fields(fields: list[T.StructField]) -> list[dict]:
    return [
        {"name": f.name, "type": f.dataType.simpleString(), "nullable": bool(f.nullable)}
        for f in fields
    ]


def signature_of(train: DataFrame, inputs: list[str], outputs: dict[str, str]) -> dict:
    """``outputs``: name -> type of what the model appends."""
    return {
        "inputs": _fields([train.schema[c] for c in inputs]),
        "outputs": [{"name": n, "type": t, "nullable": True} for n, t in outputs.items()],
    }


def problems(df: DataFrame, signature: dict) -> list[str]:
    have = {f["name"]: f for f in _fields(df.schema.fields)}
    wanted = {f["name"] for f in signature["inputs"]}
    out = []
    for f in signature["inputs"]:
        name, found = f["name"], have.get(f["name"])
        if found is None:
            close = difflib.get_close_matches(name, sorted(set(have) - wanted), n=1)
            out.append(f"{name} is missing" + (f" (renamed to {close[0]}?)" if close else ""))
        elif found["type"] != f["type"]:
            out.append(f"{name} is {found['type']}, not {f['type']}")
        elif found["nullable"] and not f["nullable"]:
            out.append(f"{name} may be null")
    return out


def enforce(df: DataFrame, signature: dict | None) -> None:
    """Raise one ``ValueError`` that names every difference."""
    if signature and (found := problems(df, signature)):
        raise ValueError("input does not fit the model's signature: " + "; ".join(found))
