"""plateia: audience-engagement analytics over video and comment tables, on Spark.

Every public function takes and returns lazy DataFrames or Columns; nothing in
the package runs a job except the readers and writers in ``plateia.sources`` and
the run driver in ``plateia.plans.pipeline``.
"""
