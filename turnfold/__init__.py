"""turnfold: match-log folding, features, learning and evaluation as Spark jobs."""

from . import schema  # noqa: F401

__version__ = "0.1.0"
