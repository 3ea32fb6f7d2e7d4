"""Operators for large-scale training-data pipelines (one module per operator).

Each module has the operator with its general interface; ``catalog`` has the thin
``opN_<name>`` queries over the driver tables and their SQL.
"""
