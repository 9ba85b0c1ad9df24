"""Materialising a small intermediate in the cluster's shared folder."""

from __future__ import annotations

from tickloom.sources.shared import materialised

__all__ = ["materialised"]
