"""veilframe: rule-driven de-identification and redaction of records on Spark."""

__version__ = "0.1.0"
