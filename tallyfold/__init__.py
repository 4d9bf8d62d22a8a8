"""File analytics on Spark: sales CSV, user/session JSON and application logs.

Every public operator takes DataFrames and returns a DataFrame; nothing is
evaluated until the caller acts, apart from the size checks and checkpoints
named in :mod:`tallyfold.session`.
"""
