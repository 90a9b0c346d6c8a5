"""Operators: timeline fold, features, weights, transforms, split, models, evaluation, scoring."""
