"""Order analytics on Spark: DataFrames in, DataFrames out.

    from tillroll import operators, plans, sources, sinks

``sources`` reads the three inputs, ``operators`` clean, join and report,
``plans`` puts them together, ``sinks`` writes the results.
"""
