"""cohortlab: behavioural and time-series analytics as Spark DataFrame jobs."""

__version__ = "0.1.0"
