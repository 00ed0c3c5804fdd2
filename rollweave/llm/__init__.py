"""Operators of a training-data pipeline: sharding, secret scans, binary records, token counts,
near-duplicate joins, language identification, decontamination, packing, line dedup, quality rules.

Nothing outside this folder imports it; ``queries`` registers one query for each operator.
"""
