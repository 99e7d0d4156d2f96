"""tagweave: linked-read analytics expressed as Spark DataFrame transformations."""

from tagweave.session import build_session, checkpointed, tune

__all__ = ["build_session", "checkpointed", "tune"]
