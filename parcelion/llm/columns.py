"""Names for added columns."""

from __future__ import annotations

from collections.abc import Iterable


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no taken name equals it (in any case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name
