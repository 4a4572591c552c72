"""visitlake: web-shop click logs to a two-grain star schema, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
