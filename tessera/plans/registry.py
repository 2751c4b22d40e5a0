"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from tessera.plans import assets, edits, keyed, tags  # noqa: F401
from tessera.plans.base import ORACLE, QUERIES  # noqa: F401
