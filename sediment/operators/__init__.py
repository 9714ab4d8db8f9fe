"""Set operators over unions of snapshots."""
