"""Infrastructure telemetry jobs on Spark: landed snapshots in, one metric table out."""
