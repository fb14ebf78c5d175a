"""Training-data operators (near and exact dedup, packing, WARC, URL filters,
quality rules, mixing, substring dedup, quality classifier, chat threads).

Nothing else in the library imports this subpackage; `queries.py` registers
its queries.
"""
