"""The four batch jobs."""

from mixloom.plans.current import current_mixes
from mixloom.plans.daily import daily_mix
from mixloom.plans.discovery import DiscoverySettings, DiscoveryTables, discovery_mix
from mixloom.plans.drift import publish_unless_drifted
from mixloom.plans.incremental import changed_users, rerank
from mixloom.plans.observed import observed_tracks
from mixloom.plans.publish import (
    MixCheckError,
    list_quality_report,
    mix_quality_report,
    publish_daily,
    publish_keyed,
    publish_mixes,
    publish_observed,
    publish_recommendations,
    row_quality_report,
)
from mixloom.plans.scoring import score_sequences

__all__ = [
    "DiscoverySettings",
    "DiscoveryTables",
    "MixCheckError",
    "changed_users",
    "current_mixes",
    "daily_mix",
    "discovery_mix",
    "list_quality_report",
    "mix_quality_report",
    "observed_tracks",
    "publish_daily",
    "publish_keyed",
    "publish_mixes",
    "publish_observed",
    "publish_recommendations",
    "publish_unless_drifted",
    "rerank",
    "row_quality_report",
    "score_sequences",
]
