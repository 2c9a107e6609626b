"""Ready plans: extracts over health-records tables, reports, and the query catalogue."""
