"""Importing this module registers every query."""

from segmint.plans import q_cluster, q_dbscan, q_eda, q_features, q_metrics, q_quality, q_score, q_segments, q_split, q_stats, q_sweeps  # noqa: F401
