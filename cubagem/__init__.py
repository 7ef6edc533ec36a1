"""Catalogs of statistical cubes on Spark: flatten, size, plan, ingest."""

from cubagem.catalog import Catalog

__all__ = ["Catalog"]
