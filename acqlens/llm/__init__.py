"""Operators for preparing language-model training data (ten, each in a module of its own).

Nothing outside this package imports it; ``__spark_entry__`` adds its queries when it is present.
"""
