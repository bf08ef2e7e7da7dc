"""Scans: dimensions, trade files and archives, rate files, the open-data catalogue."""
