"""Maps, pair lists and variants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pairs_to_map(pairs: Column) -> Column:
    """``array<array<string>>`` to a map: two-element entries only, null keys dropped, a null value is
    empty, the last of equal keys wins."""
    usable = F.filter(pairs, lambda p: (F.size(p) == 2) & p[0].isNotNull())
    keys = F.transform(usable, lambda p: p[0])
    entries = F.transform(
        usable,
        lambda p, i: F.struct(
            p[0].alias("k"), F.coalesce(p[1], F.lit("")).alias("v"), i.alias("i")
        ),
    )
    # A key's last entry is the one that no later entry repeats.
    last = F.filter(
        entries, lambda e: ~F.array_contains(F.slice(keys, e["i"] + 2, F.size(keys)), e["k"])
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["k"], e["v"])))


def flatten_lists(lists: Column) -> Column:
    """Values of a ``map<string, array<string>>`` one after the other; null values are skipped."""
    return F.flatten(F.filter(F.map_values(lists), lambda v: v.isNotNull()))


def missing_or_null(variant: Column, path: str) -> Column:
    """An entry that is there and null."""
    return F.is_variant_null(F.try_variant_get(variant, path, "variant"))
