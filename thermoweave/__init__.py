"""Sensor-event analytics written as Spark DataFrame functions."""
