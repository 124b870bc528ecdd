from .packs import DEFAULT_PACKS, Category, Incident, RulePacks, rules_table

__all__ = ["DEFAULT_PACKS", "Category", "Incident", "RulePacks", "rules_table"]
