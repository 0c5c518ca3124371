"""Satellite telemetry quality and analytics, written as Spark DataFrame transformations.

Layers: raw messages -> validated | quarantined -> deduplicated curated -> silver -> gold.
Batch and streaming share every stateless step.
"""
