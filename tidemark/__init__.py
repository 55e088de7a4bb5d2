"""tidemark: change feeds to current-state tables, and queries to reporting tables, on Spark."""

from tidemark.spec import FeedSpec, KeyBuckets, Layout, RangePartition, SettingsError, TimePartition
from tidemark.sources.snapshot import CommitConflict, SnapshotTable
from tidemark.sources.warehouse import Warehouse

__all__ = [
    "CommitConflict",
    "FeedSpec",
    "KeyBuckets",
    "Layout",
    "RangePartition",
    "SettingsError",
    "SnapshotTable",
    "TimePartition",
    "Warehouse",
]
