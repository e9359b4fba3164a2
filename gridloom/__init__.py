"""Gridded site-suitability analytics on Spark: every raster is a relation of pixels on one shared grid."""
