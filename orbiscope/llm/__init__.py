"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage.  Every operator selects
the columns it needs before doing anything else, so additional columns (even
ones named like internal ones) never reach its plan.
"""
