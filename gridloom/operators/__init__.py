"""Raster operators over pixel relations."""
