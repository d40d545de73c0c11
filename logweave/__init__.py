"""Change-log analytics on Spark: commits, positions, envelopes and sinks over recorded logs."""
