"""Release harmonisation and change tracking on Spark."""

from tidemark.operators.audit import audit_columns, pick_release_files
from tidemark.operators.harmonise import harmonise
from tidemark.operators.inventory import reconcile
from tidemark.operators.ledger import (
    apply_changes,
    latest_manifest,
    plan_changes,
    register_existing,
    repoint,
    run_summary,
)
from tidemark.operators.links import discover_releases, extract_links
from tidemark.operators.reassign import reassign_periods
from tidemark.sources.archives import expand_archives
from tidemark.sources.workbooks import read_workbooks
from tidemark.streaming.incremental import run_incremental

__all__ = [
    "apply_changes",
    "audit_columns",
    "discover_releases",
    "expand_archives",
    "extract_links",
    "harmonise",
    "latest_manifest",
    "pick_release_files",
    "plan_changes",
    "read_workbooks",
    "reassign_periods",
    "reconcile",
    "register_existing",
    "repoint",
    "run_incremental",
    "run_summary",
]
