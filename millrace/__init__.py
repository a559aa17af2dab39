"""millrace: large-scale text, table, graph, trend, sketch and vector operators on Spark.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing runs
until the caller acts on the result, unless a docstring says otherwise.
"""
