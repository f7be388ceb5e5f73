"""Operators of a training-data pipeline over ``documents`` and ``pages``.

Nothing else in the library imports this subpackage.  Each operator module has
a general interface; ``queries.py`` holds the thin ``opN_*`` queries.
"""
