"""Operators for preparing language-model training data.

Ten operators on document, conversation and vector tables. Nothing else in
the library imports this package; the registered queries are in
:mod:`lakeloom.llm.queries`.
"""
