"""notifyq: notification data quality on Spark.

Entry points:

* ``notifyq.plans.run.Run`` -- one run as lazy DataFrames (raw -> normalised -> tagged ->
  valid / rejected -> destination -> KPIs) for ad-hoc analysis;
* ``notifyq.plans.runner`` -- the operational run writing every table (``run_batch``)
  or its stages one at a time on stored inputs;
* ``notifyq.streaming.incremental`` -- one idempotent run per new landing file;
* ``notifyq.plans.model`` -- the reject-risk model;
* ``python -m notifyq`` -- the same from the command line.

Operators live in ``notifyq.operators`` (clean, rules, validate, load, kpis, profile,
anomalies, ranking), column functions in ``notifyq.functions``, sources in
``notifyq.sources``.
"""

__version__ = "0.1.0"
