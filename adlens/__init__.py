"""adlens — ad-campaign performance analytics as Spark DataFrame jobs.

Stages: validation (``operators.validate``), incremental load
(``operators.ingest``, ``streaming.incremental``), star schema
(``operators.silver``), campaign marts (``operators.gold``), anomaly rules
(``operators.anomaly``), named business queries (``operators.reports``) and
dashboard datasets (``operators.dashboard``). ``plans.pipeline`` runs them
end to end over written tables.
"""

__version__ = "0.1.0"
