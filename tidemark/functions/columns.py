"""Column helpers: quoting, case-insensitive lookup, name normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def qualified(name: str) -> str:
    return ".".join(quote(part) for part in name.split("."))


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    return F.col(quote(name))


def cols(names: Iterable[str]) -> list[str]:
    """Quoted names. They go where columns go, and for wide tables are far cheaper to pass on."""
    return [quote(n) for n in names]


def resolve(available: Sequence[str], names: Iterable[str], what: str = "column") -> list[str]:
    """The spelling used in ``available`` of each name, compared without regard to case."""
    by_lower = {c.lower(): c for c in available}
    out = []
    for name in names:
        found = by_lower.get(name.lower())
        if found is None:
            raise ValueError(f"{what} {name!r} not found among {list(available)}")
        out.append(found)
    return out


def has(df: DataFrame, name: str) -> bool:
    return name.lower() in {c.lower() for c in df.columns}


def normalize_name(name: Column, repl: str = "_") -> Column:
    """``/NS/NAME`` as it is spelled after replication: ``NS_NAME``."""
    stripped = F.when(name.startswith("/"), F.substr(name, F.lit(2))).otherwise(name)
    return F.replace(stripped, F.lit("/"), F.lit(repl))
