"""tierline: layered (bronze, silver, gold) data jobs expressed as Spark DataFrame plans.

Every public operator takes DataFrames (and a session where it must create
data) and returns DataFrames; nothing is computed on the driver beyond a
handful of scalars (marks, counts, file headers).
"""

__version__ = "0.1.0"
