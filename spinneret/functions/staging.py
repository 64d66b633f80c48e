"""Support for expressions that are built up in several projections.

The stages are SQL texts: a stage of fifty function calls is parsed at once, where fifty Column objects would each be a
call into the JVM.
"""

from __future__ import annotations


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fence(expression: str) -> str:
    """The same value, but filters and join keys on it stay above.

    A predicate that moves below a chain of projections is rewritten in terms of the chain's input: each stage is
    copied into every place where the next one uses it, and the expression grows exponentially. No predicate on what a
    generator makes moves below the generator.
    """
    return f"explode(array({expression}))"
