"""Connected components of links between documents."""

from __future__ import annotations

from ..operators.graph import components

__all__ = ["components"]
