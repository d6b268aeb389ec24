"""Land, check and summarise JSON observation feeds with Spark."""

from skyledger.session import build_session, pin_utc

__all__ = ["build_session", "pin_utc"]
