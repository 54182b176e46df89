"""Table scans, table sinks and saved-model bookkeeping."""
