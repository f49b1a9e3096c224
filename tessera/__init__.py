"""tessera: analytics operators on Spark DataFrames.

Every operator takes DataFrames and returns a DataFrame; the heavy work is
expressed with DataFrame joins, aggregates and windows so that Catalyst plans
it, with Arrow-batched pandas functions only where numpy does a block of
vector arithmetic better than per-row expressions.
"""

__version__ = "0.1.0"
