"""plumbline: grounded, rule-checked and asset-matched segment tables on PySpark.

Every public operator takes and returns DataFrames or Columns.
"""
