"""Training-data operators: dedup, decontamination, mixing, filters and token output.

Nothing outside this subpackage imports it.
"""
