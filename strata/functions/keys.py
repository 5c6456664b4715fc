"""Surrogate hash keys.

The key of a fact row is ``md5`` of its parts joined by ``'-'``, where a NULL
part contributes the empty string but keeps its separator (the text
``concat`` rule of the serving database). Spark's ``concat`` returns NULL for
any NULL input and ``concat_ws`` drops the separator too, so each part is
cast to text and defaulted to ``''`` first.

Timestamp parts render as ``yyyy-MM-dd HH:mm:ss[.ffffff]`` (trailing zero
fraction trimmed) in the session zone, which is pinned to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "-"


def _text(c) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col.cast("string"), F.lit(""))


def key_text(*parts) -> Column:
    """Parts as text joined by '-', NULL parts as ''."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            pieces.append(F.lit(SEPARATOR))
        pieces.append(_text(p))
    return F.concat(*pieces)


def hash_key(*parts) -> Column:
    """md5 hex digest of ``key_text(*parts)``; never NULL."""
    if all(isinstance(p, str) for p in parts):
        return F.expr(hash_key_sql(*parts))
    return F.md5(key_text(*parts))


def key_text_sql(*names: str) -> str:
    pieces = []
    for i, n in enumerate(names):
        if i:
            pieces.append(f"'{SEPARATOR}'")
        pieces.append(f"coalesce(cast({n} AS string), '')")
    return f"concat({', '.join(pieces)})"


def hash_key_sql(*names: str) -> str:
    return f"md5({key_text_sql(*names)})"
