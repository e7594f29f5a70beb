"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage; it brings its own
registry of queries (:mod:`foliary.llm.registry`).
"""
