"""Event-flow data work on Spark: envelopes, reshaping, routing, replay, landing."""
