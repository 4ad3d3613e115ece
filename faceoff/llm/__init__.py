"""Operators of a training-data pipeline: formatting, deduplication, scoring, counting and mixing.

Nothing else in the library imports this subpackage. The registered queries are
in ``faceoff.llm.registry``, their SQL in ``faceoff.llm.oracle``.
"""
