"""cyclewise: Spark-native equipment-telemetry analytics.

Run-to-failure trajectories -> remaining-useful-life labels -> per-unit window
features -> models and ensembles -> evaluation -> drift statistics -> monitoring
queries and gates, all as DataFrame / SQL / Structured Streaming plans.
"""

__version__ = "0.1.0"
