"""Collected records to validated, cleaned, reported and modelled tables, on Spark.

Every public function takes and returns DataFrames (or Columns) and runs no
action by itself, except where its name says so (``write_*``, ``fit_*``,
``start_*``, ``run_*``).
"""
