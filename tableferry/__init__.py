"""Full-refresh table replication and load validation on Spark."""

from tableferry.functions.projection import ProjectionOptions, project
from tableferry.functions.rowhash import row_hash, with_row_hash
from tableferry.operators.target import Target
from tableferry.plans.profile import catalog_profile
from tableferry.plans.reconcile import reconcile
from tableferry.plans.sync import SyncOptions, SyncRun, sync_all, sync_table
from tableferry.session import build_session, shared_root
from tableferry.sources import CatalogSource, FrameSource, JdbcSource, ParquetSource, Split

__all__ = [
    "CatalogSource",
    "FrameSource",
    "JdbcSource",
    "ParquetSource",
    "ProjectionOptions",
    "Split",
    "SyncOptions",
    "SyncRun",
    "Target",
    "build_session",
    "catalog_profile",
    "project",
    "reconcile",
    "row_hash",
    "shared_root",
    "sync_all",
    "sync_table",
    "with_row_hash",
]
