"""docloom: document and metadata analytics, written for Spark's DataFrame engine."""

__all__ = ["session"]
