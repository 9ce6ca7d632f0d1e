"""Deterministic draws and key formatting, as SQL expression text.

Random draws are integer hashes ``(key * a + b) mod p`` so that Spark and a SQL
oracle produce identical tables regardless of partitioning. The key is reduced
mod ``p`` first, which gives the same value and cannot overflow a bigint.

The helpers return SQL text for ``selectExpr``: a wide projection is then one
parse on the JVM instead of thousands of Python-to-JVM calls per query.
"""

from __future__ import annotations

from collections.abc import Sequence


def draw_sql(key: str, a: int, b: int, p: int) -> str:
    """``(key * a + b) % p`` for a non-negative bigint key."""
    return f"((({key}) % {p}) * {a} + {b}) % {p}"


def key_sql(prefix: str, key: str, width: int) -> str:
    """``prefix`` + decimal key with zeros up to ``width``, e.g. ``CLM0000000042``; longer keys stay whole."""
    digits = f"cast({key} as string)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


def pick_sql(values: Sequence[str], index: str) -> str:
    """Element ``index`` (0-based) of a literal list; out of range gives NULL."""
    items = ", ".join("'" + v.replace("'", "\\'") + "'" for v in values)
    return f"get(array({items}), cast({index} as int))"
