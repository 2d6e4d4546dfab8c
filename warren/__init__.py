"""Spark-native analytics for maze tracking, spike trains, field potentials and session catalogues."""
