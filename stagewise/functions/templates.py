"""Placeholders in SQL and contract templates."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from stagewise.contract import ContractError

_PLACEHOLDER = re.compile(r"\{\{\s*(\w+)\s*\}\}")
# What other template languages have and this one does not.
_CONTROL = re.compile(r"\{%.*?%\}|\{#.*?#\}|\{\{.*?\}\}", re.DOTALL)


def render(sql: str, values: Mapping[str, Any]) -> str:
    """Fill ``{{ name }}`` placeholders; a name without a value is an error, and so are control words and filters."""

    def fill(match: re.Match[str]) -> str:
        name = match.group(1)
        if name not in values:
            raise ContractError(f"the template needs a value for '{name}'")
        return str(values[name])

    control = _CONTROL.search(_PLACEHOLDER.sub("", sql))
    if control:
        raise ContractError(f"templates only have names in double braces, not {control[0]!r}")
    return _PLACEHOLDER.sub(fill, sql)
