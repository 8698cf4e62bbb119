"""flowlake: labelled flow records -> cleaned fact and aggregates on Spark."""

__version__ = "0.1.0"
