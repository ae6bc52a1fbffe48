"""Queries over the driver's tables, each with SQL that gives the same rows."""

from workload import containers, files, ledger, lineage, links, releases, streams

AREAS = (releases, files, links, ledger, lineage, containers, streams)
