"""Card-transaction analytics and fraud detection as Spark DataFrame operators.

Everything here is a function from DataFrame (or Column) to DataFrame (or
Column): batch jobs, micro-batches and ad-hoc queries share the same code and
leave physical planning to Catalyst and AQE.
"""

__version__ = "0.1.0"
