"""Column builders: casts, bands, masks, keys, dates and text rules."""
