"""Scalar functions as SQL expression text.

Each takes expression text and returns expression text, for `selectExpr`, `where` and
`F.expr`. A plan with dozens of generated expressions is so handed to Spark in a few calls
instead of in thousands of small ones.
"""
