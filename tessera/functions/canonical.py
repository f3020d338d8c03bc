"""Name canonicalisation (exact-match replace rules around a ``lower``).

A rule set is a plain ``{input: output}`` dict.  Rules never chain (no
output is another rule's input), so the whole set is one lookup: a single
``CASE`` for small sets, a literal map with ``try_element_at`` for larger
ones.  Unknown values keep their value; null stays null.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: must equal the reference's rules for identical names ---
# Listing neighbourhoods, applied to the raw (case-sensitive) value.
LISTING_PRE_RULES = {
    "Vallvidrera - El Tibidabo i les Planes": "Vallvidrera, el Tibidabo i les Planes",
    "Vila de Gràcia": "la Vila de Gràcia",
}
# Listing neighbourhoods, applied after lower-casing.
LISTING_POST_RULES = {
    "el poble sec - parc de montjuïc": "el poble sec - aei parc montjuïc",
    "la marina del prat vermell": "la marina del prat vermell - aei zona franca",
    "sant pere - santa caterina i la ribera": "sant pere, santa caterina i la ribera",
    "ciutat meridiana - torre baró - vallbona": "ciutat meridiana",
    "la vall d'hebron - la clota": "la vall d'hebron",
    "el gòtic": "el barri gòtic",
    "can peguera - el turó de la peira": "can peguera",
    "sant genís dels agudells - montbau": "sant genís dels agudells",
    "la marina del port": "la marina de port",
}
# Housing neighbourhoods, applied after lower-casing.
HOUSING_RULES = {
    "el poble sec - parc montjuïc": "el poble sec - aei parc montjuïc",
    "la marina del prat vermell - zona franca": "la marina del prat vermell - aei zona franca",
}
# --- end of fixed values ---

_CASE_LIMIT = 64


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def replace_values(c, rules: dict) -> Column:
    """Exact-match replacement; values without a rule are kept."""
    c = _as_col(c)
    if not rules:
        return c
    if len(rules) <= _CASE_LIMIT:
        expr = None
        for src, dst in rules.items():
            cond = c == F.lit(src)
            expr = F.when(cond, F.lit(dst)) if expr is None else expr.when(cond, F.lit(dst))
        return expr.otherwise(c)
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(rules.items())])
    return F.coalesce(F.try_element_at(mapping, c), c)


def canonicalise(c, pre: dict | None = None, post: dict | None = None,
                 lower: bool = True) -> Column:
    """``post(lower(pre(c)))`` as one expression."""
    out = replace_values(c, pre or {})
    if lower:
        out = F.lower(out)
    return replace_values(out, post or {})
