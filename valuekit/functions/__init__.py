"""Native column expressions used by the operators."""

from valuekit.functions.columns import (  # noqa: F401
    literal_map,
    lookup,
    not_blank,
    not_sentinel,
    ratio,
    season_start_year,
    text_to_integer,
    strip_cr,
    weighted_sum,
    within,
)
