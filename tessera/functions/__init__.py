"""Column expressions (JVM-side, codegen-friendly; no Python UDFs)."""

from tessera.functions.canonical import (
    HOUSING_RULES,
    LISTING_POST_RULES,
    LISTING_PRE_RULES,
    canonicalise,
    replace_values,
)
from tessera.functions.keys import concat_key, surrogate_key
from tessera.functions.scalars import (
    indicator,
    to_decimal_via_float,
    to_double,
    year_from_name,
)

__all__ = [
    "HOUSING_RULES",
    "LISTING_POST_RULES",
    "LISTING_PRE_RULES",
    "canonicalise",
    "concat_key",
    "indicator",
    "replace_values",
    "surrogate_key",
    "to_decimal_via_float",
    "to_double",
    "year_from_name",
]
