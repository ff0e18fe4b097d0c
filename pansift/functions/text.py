"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference: characters mapped when a
# label becomes part of a column name, and the trademark signs removed from
# event titles.
NAME_CHAR_MAP = {" ": "_", "/": "_", "-": "_", "&": "AND"}
TRADEMARK_SIGNS = "℠®™"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """Strip every leading/trailing whitespace char (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def strip_symbols_expr(c) -> Column:
    return strip_all(F.regexp_replace(_c(c), f"[{TRADEMARK_SIGNS}]", ""))


def safe_name(value: str, prefix: str = "topk_", suffix: str = "_cnt") -> str:
    """Label value -> column name (space, slash, hyphen -> ``_``; ``&`` -> ``AND``)."""
    out = str(value)
    for k, v in NAME_CHAR_MAP.items():
        out = out.replace(k, v)
    return f"{prefix}{out}{suffix}"
