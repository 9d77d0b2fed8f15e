"""Header handling of uploaded files. Works on column names only; no data is touched."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def normalise_header(name: str) -> str:
    """``'LEI '`` and ``'\\ufeffLEI'`` become ``'lei'``; a header without letters or digits ``'unnamed'``."""
    words = re.findall(r"[a-z0-9]+", name.replace("\ufeff", "").lower())
    return "_".join(words) or "unnamed"


def unique_headers(names: Iterable[str]) -> list[str]:
    """Normalised names; repeats get the next free ``_2``, ``_3``, ... so that none collide."""
    result: list[str] = []
    used: set[str] = set()
    for base in map(normalise_header, names):
        name, n = base, 1
        while name in used:
            n += 1
            name = f"{base}_{n}"
        used.add(name)
        result.append(name)
    return result


def require_any(df: DataFrame, names: Iterable[str], what: str) -> None:
    """Raise unless at least one of the columns is present."""
    wanted = list(names)
    if not set(wanted) & set(df.columns):
        raise ValueError(f"{what}: no column {' or '.join(wanted)} among {', '.join(df.columns)}")


def fill_missing(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Add absent optional columns as null strings."""
    absent = {n: F.lit(None).cast("string") for n in names if n not in df.columns}
    return df.withColumns(absent) if absent else df


def rename_legacy(df: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """Rename old header names, each only if the current name is absent."""
    return df.withColumnsRenamed({old: new for old, new in aliases.items() if new not in df.columns})
