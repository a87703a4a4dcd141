"""Rule catalog and target-table sources."""
