"""Catalogues, rasters and sinks."""
