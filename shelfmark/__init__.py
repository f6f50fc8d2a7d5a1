"""Shelfmark: review analytics as Spark DataFrame functions.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns). Nothing here starts a session or collects a result; the few places
that run a small job while a plan is being built say so in their docstring.
"""
