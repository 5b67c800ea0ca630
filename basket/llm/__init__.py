"""Training-data operators: one module per operator, queries in ``registry``.

Nothing else in the library imports this subpackage.
"""
