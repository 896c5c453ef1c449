"""Readers and writers."""

from .archive import *  # noqa: F401,F403
from .buckets import *  # noqa: F401,F403
from .scans import *  # noqa: F401,F403
from .sinks import *  # noqa: F401,F403
