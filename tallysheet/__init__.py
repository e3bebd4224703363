"""Sales analytics on PySpark: extraction, monthly replace, pricing, fact table, checks."""

from tallysheet.config import DEFAULT_RULES, BranchRule, Rules, SalesSource

__all__ = ["DEFAULT_RULES", "BranchRule", "Rules", "SalesSource"]
