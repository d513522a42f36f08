"""DataFrame operators: shaping, merging, fetching, tombstones, checks, logs."""
