"""Continuous classification over a nested JSON feed, as Spark DataFrame, streaming and MLlib jobs."""

from perigee import functions, operators, plans, sources, streaming

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
