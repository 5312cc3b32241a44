"""String helpers: token search and record keys."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelake.fixed_values import NULL_IN_KEY


def contains_any(text: Column, tokens: Iterable[str]) -> Column:
    """Plain substring search for any of the tokens."""
    return reduce(or_, (text.contains(token) for token in tokens), F.lit(False))


def key_part(value: Column) -> Column:
    """A value inside a key; null is spelled out so the key stays defined."""
    return F.coalesce(value.cast("string"), F.lit(NULL_IN_KEY))


def record_key(*parts: Column | str) -> Column:
    """Parts joined by ``_``; pass literals as columns, names as strings."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("_", *[key_part(c) for c in cols])


def path_safe(value: Column) -> Column:
    """Blanks and slashes would change the meaning of a key."""
    return F.translate(value, " /", "__")
