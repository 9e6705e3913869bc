"""Reading and writing: scans, strict CSV, binary files, contracts, snapshots."""
