"""Operators for preparing training data, and their queries.

Nothing else in the library imports this subpackage. ``queries.py`` lists the
registered queries; ``corpus_pipeline.py`` at the top of the repository chains
five of the operators.
"""
