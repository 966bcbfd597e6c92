from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENRICHMENT_COLUMNS
from .dedup import keep_last
from .lookup import skew_safe_lookup


def enrich_user_events(
    events: DataFrame,
    profiles: DataFrame | None,
    profile_order: Sequence[str] | None = None,
    hot_from: DataFrame | None = None,
) -> DataFrame:
    """Events with country, signup source and company size of their user.

    Every event stays, with nulls where the user is unknown. Enrichment columns the events bring
    along are replaced. Pass `profile_order` if the profiles may hold several rows per user (the
    last one counts); cleaned profiles hold one. An event without a user matches no profile.
    """
    if profiles is None:
        return events.withColumns(
            {c: F.lit(None).cast("string") for c in ENRICHMENT_COLUMNS if c not in events.columns}
        )
    available = [c for c in ENRICHMENT_COLUMNS if c in profiles.columns]
    bare = events.drop(*available)
    if available:
        unique = keep_last(profiles, ["user_id"], profile_order) if profile_order else profiles
        bare = skew_safe_lookup(bare, unique, "user_id", available, "event_id", hot_from)
    return bare.withColumns(
        {c: F.lit(None).cast("string") for c in ENRICHMENT_COLUMNS if c not in bare.columns}
    )
