"""Operators for preparing training data: ten corpus-scale jobs, each a module of its own."""
