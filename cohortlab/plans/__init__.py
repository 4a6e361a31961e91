"""Registered queries (Spark form + SQL twin, see ``registry``) and plan
guards (``guards``)."""
