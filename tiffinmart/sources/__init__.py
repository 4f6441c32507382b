"""CSV landing: scans with file lineage, file fingerprints, the load ledger."""
