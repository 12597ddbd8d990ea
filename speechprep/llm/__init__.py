"""Training-data operators: quality, dedup, packing, tokenising, scans.

Nothing outside this subpackage (and the driver entry) imports it.
"""
