"""Customer-experience analytics for e-commerce orders, written as Spark jobs."""

__version__ = "0.1.0"
