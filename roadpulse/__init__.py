"""roadpulse: batch and streaming analytics over road incident and congestion reports.

Every public function takes and returns DataFrames (or Columns) and stays lazy unless its
docstring says that it materialises something.
"""
