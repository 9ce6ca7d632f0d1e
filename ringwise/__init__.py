"""ringwise: graph risk analytics for claims data, written as Spark DataFrame jobs."""

from ringwise.config import RiskConfig

__all__ = ["RiskConfig"]
