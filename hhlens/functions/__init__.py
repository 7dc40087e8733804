"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from hhlens.functions.recode import (  # noqa: F401
    any_nonzero, decode, dummy, flag, guard, inset, is_missing, null_guarded,
    square, threshold,
)
from hhlens.functions.randomness import portable_hash  # noqa: F401
