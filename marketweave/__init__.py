"""Market-data preparation on Spark: bars, repairs, audits, merges, point-in-time financials and snapshots as DataFrame functions."""
