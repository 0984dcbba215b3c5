"""Models (silver, gold), contracts, snapshots, the full build and the query catalogue."""
