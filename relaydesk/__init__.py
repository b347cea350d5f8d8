"""Message triage and triage evaluation as PySpark DataFrame jobs."""

from relaydesk.plans.triage import System, triage

__all__ = ["System", "triage"]
