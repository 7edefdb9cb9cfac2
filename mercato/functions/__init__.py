"""Column expressions (built-in Spark functions only)."""

from mercato.functions.columns import *  # noqa: F401,F403
