"""Spark operators that turn interval telemetry into trusted analytical tables."""
