"""burstframe - transient-burst analytics as PySpark DataFrame operators."""

from burstframe.session import build_session, tune

__all__ = ["build_session", "tune"]
