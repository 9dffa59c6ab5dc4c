"""Column expressions; every function returns a JVM-side ``Column``."""

from . import bases, cigar, coords, flags, tags  # noqa: F401
