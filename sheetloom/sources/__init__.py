"""Sheet ranges, source specs, catalog tables and sinks."""
