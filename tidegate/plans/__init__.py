"""Complete loads, composed from the operators.

Each function takes DataFrames and a run date or window and returns the named
outputs as lazy DataFrames. Writing is left to ``tidegate.sinks``.
"""
