"""Incremental forms of the commutative folds."""
