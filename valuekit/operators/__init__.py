"""Generic, parameterised DataFrame -> DataFrame operators."""

from valuekit.operators.clean import (  # noqa: F401
    add_season_start_year,
    cast_columns,
    drop_blank_keys,
    drop_sentinels,
    fill_defaults,
    flag_not_sentinel,
    map_codes,
    null_outside,
    parse_money_text,
    split_record,
    strip_carriage_returns,
    win_share,
)
from valuekit.operators.dedupe import consolidate, prefer_tagged_rows  # noqa: F401
from valuekit.operators.join import normalize_to_cap, unify  # noqa: F401
from valuekit.operators.lookup import filter_results, player_history, select_present, wasted_cap  # noqa: F401
from valuekit.operators.metrics import (  # noqa: F401
    availability,
    production_expr,
    composite_value,
    qualify_for_archetypes,
    qualify_for_scoring,
    per36_rates,
    per_game_rates,
    per_minute_rates,
    value_metrics,
)
from valuekit.operators.quality import (  # noqa: F401
    cleaning_summary,
    duplicate_key_report,
    duplicate_keys,
    key_profile,
    null_key_report,
    preview,
)
from valuekit.operators.rank import (  # noqa: F401
    archetype_season_rollup,
    label_distribution,
    season_report,
    top_k_per_group,
)
from valuekit.operators.rules import RuleSet, archetype_rules  # noqa: F401
from valuekit.operators.tiers import assign_tiers, bucket_expr, tier_value_score  # noqa: F401
