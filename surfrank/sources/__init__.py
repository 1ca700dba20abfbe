"""Edge and vector sources, result sinks, and edge graphs over parquet tables."""
