"""Registered queries."""

from doclattice.plans import contracts, queries, structures  # noqa: F401
