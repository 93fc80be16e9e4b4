"""Scalar column expressions (all JVM-side, codegen-friendly)."""

from claimsmith.functions.exprs import *  # noqa: F401,F403
