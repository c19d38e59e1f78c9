"""Traversal state of a node, derived from its distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unseen, on the frontier, done; later entries are darker.
COLOURS = ("WHITE", "GRAY", "BLACK")


def colour_of(distance: Column, rounds: int) -> Column:
    """Colour after `rounds` rounds: unreached nodes are unseen, nodes reached
    in the last round form the frontier, earlier ones are done."""
    return (
        F.when(distance.isNull(), COLOURS[0])
        .when(distance >= rounds, COLOURS[1])
        .otherwise(COLOURS[2])
    )


def colour_rank(colour: Column) -> Column:
    return (F.array_position(F.array(*map(F.lit, COLOURS)), colour) - 1).cast("int")


def rank_colour(rank: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, COLOURS)), rank + 1)
