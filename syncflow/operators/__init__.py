"""DataFrame operators: row transforms, changelogs, day partitions, reconciliation, monitoring."""
