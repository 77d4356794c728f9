"""Spark jobs that build, enrich and check a curated title dataset."""

from marquee.config import JobConfig

__all__ = ["JobConfig"]
