"""Spark-native GTFS timetable engine."""

__version__ = "0.1.0"
