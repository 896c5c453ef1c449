"""DataFrame operators."""

from .cleaning import *  # noqa: F401,F403
from .dedupe import *  # noqa: F401,F403
from .entities import *  # noqa: F401,F403
from .graph import *  # noqa: F401,F403
from .hydration import *  # noqa: F401,F403
from .linking import *  # noqa: F401,F403
from .scale import *  # noqa: F401,F403
from .search import *  # noqa: F401,F403
from .sheets import *  # noqa: F401,F403
from .status import *  # noqa: F401,F403
from .trials import *  # noqa: F401,F403
