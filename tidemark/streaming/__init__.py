"""Structured Streaming forms."""

from .compaction import *  # noqa: F401,F403
from .live import *  # noqa: F401,F403
from .stateful import *  # noqa: F401,F403
