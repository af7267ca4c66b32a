"""Reading stages: typed scans and file listings."""
