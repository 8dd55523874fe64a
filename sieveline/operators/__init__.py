"""Pipeline operators; importing this package registers all of them."""

from sieveline.operators import perception, phash, rules, semantic  # noqa: F401
