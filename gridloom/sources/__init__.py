"""Sources and sinks: virtual rasters, layers, manifests, GeoTIFF, PNG, vector features."""
