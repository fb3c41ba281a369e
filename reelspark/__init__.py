"""Spark-first engine for tables derived from video: catalogs, frames, scenes, keyframes, texts and speech."""

__version__ = "0.1.0"
