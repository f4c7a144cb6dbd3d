"""A PySpark engine for BGP routing telemetry."""
