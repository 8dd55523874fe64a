"""Operators by name."""

from __future__ import annotations

_OPERATORS: dict[str, type] = {}


def register_op(name: str):
    """Class decorator; a name can be given once."""

    def add(cls: type) -> type:
        if name in _OPERATORS:
            raise ValueError(f"operator {name!r} is registered already")
        cls.name = name
        _OPERATORS[name] = cls
        return cls

    return add


def get_op(name: str) -> type:
    if name not in _OPERATORS:
        raise KeyError(f"no operator {name!r}; registered: {', '.join(list_ops())}")
    return _OPERATORS[name]


def build_op(name: str, params: dict | None = None):
    """The operator ``name`` with these parameters; fails at once for unknown names or parameters."""
    return get_op(name)(**(params or {}))


def list_ops() -> list[str]:
    return sorted(_OPERATORS)
