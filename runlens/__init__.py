"""runlens: experiment-metric monitoring expressed as Spark DataFrame plans.

Layers:
  sources/    readers for runs, experiments and dimension payloads; fixtures from `events`
  functions/  Column-expression helpers (status rules, map handling, safe statistics)
  operators/  DataFrame -> DataFrame building blocks (flatten, enrich, series, summaries,
              profiles, quality checks, alerts, job metrics)
  sinks/      snapshot writes, snapshot log, layout inference, threshold upserts
  plans/      batch jobs and the registered query catalog
  streaming/  incremental ingestion with Structured Streaming
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
