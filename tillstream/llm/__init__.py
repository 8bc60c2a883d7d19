"""Training-data operators over ``documents``, ``pages`` and ``benchmark``.

Nothing else in the package imports this subpackage.  Every operator takes
DataFrames, does its distributed work through Spark and returns a DataFrame;
``queries`` registers one thin query per operator.
"""
