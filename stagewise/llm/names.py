"""Names for helper columns that no column of the input has."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as it takes to be free, whatever the case."""
    taken, found = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
