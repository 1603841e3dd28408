"""Event analytics as Spark jobs: raw -> staging -> curated -> mart."""

from eventloom.session import build_session

__all__ = ["build_session"]
