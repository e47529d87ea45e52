"""Writing results to catalog tables."""

from clientele.sinks.tables import drop_table, overwrite_table, restore_table

__all__ = ["drop_table", "overwrite_table", "restore_table"]
