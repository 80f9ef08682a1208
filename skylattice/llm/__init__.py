"""Training-data operators: filtering, deduplication, scoring, packing and token output.

Nothing else in the library imports this subpackage.
"""
