"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  Every operator keeps its own
general interface; ``spotweave.llm.queries`` holds the thin contract queries.
"""
