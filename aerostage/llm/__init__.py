"""Training-data operators: one module for each operator, queries in ``catalog``, their SQL in ``oracle``.

Nothing else in the library imports this package. On a cluster the library has to be importable on the
executors (``--py-files`` or installed), because the Arrow functions of these modules run there.
"""
