"""Per-user transaction features and event-stream totals, written for Spark."""

from purseline.schema import EVENT_SCHEMA, Events, Transactions

__all__ = ["EVENT_SCHEMA", "Events", "Transactions"]
