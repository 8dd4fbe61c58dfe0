"""Column-level helpers (all Catalyst built-ins, no Python UDFs)."""

from . import constants, numbers, text  # noqa: F401
