"""Per-account behavioural features over transaction data, as Spark jobs."""

__version__ = "0.1.0"
