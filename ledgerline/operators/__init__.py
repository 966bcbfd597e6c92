from .asof import asof_last
from .clean import (
    CleaningCounts,
    clean_subscriptions,
    clean_transactions,
    clean_user_events,
    clean_user_profiles,
    require_columns,
)
from .dedup import keep_first, keep_last
from .enrich import enrich_user_events
from .funnel import funnel, quantiles
from .history import as_of, merged_by, with_versions
from .keys import with_dense_keys
from .lookup import skew_safe_lookup
from .merge import conform, rows_in, rows_not_in, upserted

__all__ = [
    "CleaningCounts",
    "as_of",
    "asof_last",
    "clean_subscriptions",
    "clean_transactions",
    "clean_user_events",
    "clean_user_profiles",
    "conform",
    "enrich_user_events",
    "funnel",
    "keep_first",
    "keep_last",
    "merged_by",
    "quantiles",
    "require_columns",
    "rows_in",
    "rows_not_in",
    "skew_safe_lookup",
    "upserted",
    "with_dense_keys",
    "with_versions",
]
