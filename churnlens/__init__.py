"""churnlens: subscriber churn analytics as Spark jobs.

Layers: ``sources`` (schemas, adapters, catalog, sinks), ``functions`` (column helpers),
``operators`` (feature views, evaluation, quality, monitoring, business rules, model,
explanations), ``plans`` (workspace, feature store, query catalogue, SQL oracle) and
``streaming`` (monitor, incremental views, scoring).
"""

__version__ = "0.1.0"
