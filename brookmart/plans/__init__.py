"""The warehouse jobs: detail tables (log, trade, refund, coupon, user) and windowed results.

Each is a function from DataFrames to a DataFrame and runs on tables and on streams, except where
its docstring names the stream counterpart in ``brookmart.plans.live``.
"""
