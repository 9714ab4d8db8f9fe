"""Where snapshots are read from and where results go."""
