"""Column expressions (JVM-side, codegen-friendly) used by the operators."""
from .scalars import *  # noqa: F401,F403
