"""Training-data operators: archives, filters, deduplication, decontamination, tokens.

Nothing else in the package imports this subpackage; it may be deleted whole.
"""
