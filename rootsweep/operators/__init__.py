"""Relational operators of a cascade move: root selection, key-set closure,
semi / anti / flag joins, guards and reports."""
