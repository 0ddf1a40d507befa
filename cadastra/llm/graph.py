"""Connected components, as the engine finds them."""

from __future__ import annotations

from cadastra.operators.graph import components

__all__ = ["components"]
