"""Operators of a large-scale training-data pipeline, one module per operator.

Each module keeps a general interface (DataFrame in, DataFrame out, column names as
parameters); :mod:`scoutlens.llm.queries` binds them to the test tables. Nothing else in
the library imports this subpackage.
"""
