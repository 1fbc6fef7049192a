"""Incremental refresh applied batch by batch (batch jobs or foreachBatch)."""

from shelfline.streaming import channels, dimensions, refresh  # noqa: F401
