"""Reliable event ingestion, quarantine and replay, and trip analytics on Spark."""
