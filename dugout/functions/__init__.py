"""Column expressions: every function returns a native Spark ``Column``."""

from . import dates, scalar, web  # noqa: F401
