"""Sessions and catalog tables to read from."""

from clientele.sources.session import get_session
from clientele.sources.tables import read_table

__all__ = ["get_session", "read_table"]
