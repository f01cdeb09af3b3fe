"""Column-level building blocks (pure ``Column -> Column`` helpers)."""
from paneltide.functions.columns import *  # noqa: F401,F403
