"""Writers: CSV folders, snapshots, catalog tables."""
