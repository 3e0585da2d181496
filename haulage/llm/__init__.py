"""Operators for preparing training data at corpus scale.

Nothing outside this subpackage imports it. ``queries.py`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five
of them.
"""
