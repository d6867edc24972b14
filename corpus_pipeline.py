"""Corpus pipeline over ``documents``: quality, repeated lines, near copies,
benchmark passages, packing.  The stages are those of ``scorewell.llm.pipeline``.
"""

from scorewell.llm.pipeline import ORACLE_SQL, STAGES, decontaminate, line_dedup, near_copies, packing, quality, run

__all__ = ["ORACLE_SQL", "STAGES", "decontaminate", "line_dedup", "near_copies", "packing", "quality", "run"]
