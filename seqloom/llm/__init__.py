"""Training-data operators: Spark jobs over ``documents``-shaped tables.

Nothing outside this subpackage imports it.  Every operator takes and returns
DataFrames; intermediate tables go to the shared folder of ``spark.checkpoint.dir``.
"""
