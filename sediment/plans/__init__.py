"""The two jobs: merge and convert."""
