"""The engine's inputs expressed over the driver's tables, and the registered queries.

The tables hold no service requests, so each raw input is a fixed projection of one or two of them.
Projections are plain SQL text that Spark and the checking database both read.
"""
