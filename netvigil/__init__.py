"""netvigil: network-flow threat analytics as plain PySpark functions.

Every operator takes DataFrames (or Columns) and returns a DataFrame (or
Column). Sessions are passed in and never stopped here.
"""

__version__ = "0.1.0"
