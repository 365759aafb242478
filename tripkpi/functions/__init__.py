"""Column expressions used by the pipeline."""

from tripkpi.functions.columns import *  # noqa: F401,F403
