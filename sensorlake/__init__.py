"""Sensor-lake analytics on Spark: files -> bronze -> silver -> gold -> checks."""
