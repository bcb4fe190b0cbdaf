"""shoplens: retail click-log and ad-stream analytics written as Spark DataFrame jobs."""

__version__ = "0.1.0"
