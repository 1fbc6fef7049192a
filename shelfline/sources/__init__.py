"""Readers and writers."""

from shelfline.sources import io  # noqa: F401
