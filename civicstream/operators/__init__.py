"""DataFrame operators. Each takes and returns DataFrames; column names and thresholds
are arguments so the same operator runs on telemetry feeds and on other tables."""
