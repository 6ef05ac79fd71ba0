"""basketlens: retail customer and campaign-response analytics on Spark.

Subpackages: ``sources`` (schemas, inputs, file I/O), ``functions`` (Column
functions), ``operators`` (DataFrame -> DataFrame operators), ``plans``
(configuration presets, the full pipeline and the registered query catalog),
``streaming`` (intentionally empty, see its docstring).
"""
