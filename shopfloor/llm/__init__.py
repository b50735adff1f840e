"""Training-data operators: ten dealt operators over the synthetic corpus tables.

Nothing outside this folder imports it; `queries` registers one thin query
per operator, the operators themselves keep general interfaces.
"""
