"""Whole jobs: compositing with resume, layer building, site analysis, reports."""
