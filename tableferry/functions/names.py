"""Table and column naming."""

from __future__ import annotations

import re

_PART = re.compile(r"`(?:[^`]|``)*`|[^.`]+")


def quote(name: str) -> str:
    """Back-quote one identifier part; embedded back-ticks are doubled."""
    return "`" + name.replace("`", "``") + "`"


def qualified(*parts: str) -> str:
    return ".".join(quote(p) for p in parts)


def identifier_parts(identifier: str) -> list[str]:
    """Split ``a.`b.c`.d`` into its parts, without the back-quotes."""
    parts = _PART.findall(identifier)
    return [p[1:-1].replace("``", "`") if p.startswith("`") else p for p in parts]


def short_name(identifier: str) -> str:
    """Default sink table name: the last part of a table id, or the stem of a path."""
    if "/" in identifier:
        return identifier.rstrip("/").rsplit("/", 1)[-1].split(".", 1)[0]
    parts = identifier_parts(identifier)
    return parts[-1] if parts else ""
