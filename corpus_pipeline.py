"""The cleaning pipeline over ``documents``; its stages live in ``evidence_atlas.llm.pipeline``."""

from evidence_atlas.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
