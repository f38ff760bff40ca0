"""See the modules of this subpackage."""

from . import queries  # noqa: F401
from . import block_queries  # noqa: E402, F401, I001
from . import structure_queries  # noqa: E402, F401, I001
