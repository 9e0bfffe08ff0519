"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage.  Each operator module
keeps its own general interface; :mod:`quadrille.llm.queries` holds the thin
queries that apply the operators to whole tables.
"""
