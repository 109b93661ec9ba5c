"""tokenmill: corpus preparation and token analytics as Spark jobs."""

__version__ = "0.1.0"
