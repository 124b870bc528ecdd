"""causeway: root-cause analytics for application error logs on Spark."""

from .rules import DEFAULT_PACKS, RulePacks

__all__ = ["DEFAULT_PACKS", "RulePacks"]
