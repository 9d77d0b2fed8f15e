"""Company-name resolution on Spark: ingest, match, add parents, map to an internal list."""

from namebridge.config import MatchConfig

__all__ = ["MatchConfig"]
