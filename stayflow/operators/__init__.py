"""Generic DataFrame operators: ordered scans, joins, intervals, cohorts, updates."""
