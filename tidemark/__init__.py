"""Social-post analytics as Spark DataFrame operators."""

from .session import build_session, prepare, release, work_dir

__all__ = ["build_session", "prepare", "release", "work_dir"]
