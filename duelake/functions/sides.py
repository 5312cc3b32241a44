"""Expressions over rows that describe both sides of a contest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decide_winner(score1: Column, score2: Column, first: Column, second: Column, otherwise: Column) -> Column:
    """``first`` or ``second`` by score; a tie or a null score is undecided."""
    return F.when(score1 > score2, first).when(score2 > score1, second).otherwise(otherwise)


def won_flag(own: Column, other: Column) -> Column:
    """1 for a win, else 0: a draw or a null score is not a win for either side."""
    return F.when(own > other, 1).otherwise(0)


def pick_side(who: Column, id1: Column, value1: Column, id2: Column, value2: Column) -> Column:
    """The value of the side ``who`` belongs to; null when it is neither."""
    return F.when(who == id1, value1).when(who == id2, value2)
