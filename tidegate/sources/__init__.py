"""Scans: text, delimited files, catalog, inventories and control tables."""
