"""Operators for preparing language-model training data, each with one
registered query (``queries.py``).  Nothing else in the library imports
this subpackage."""
