"""Every query of this subpackage, and the pipeline that strings its operators together."""

from __future__ import annotations

import corpus_pipeline
from stagewise.llm.queries import ORACLE, QUERIES

QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

__all__ = ["ORACLE", "QUERIES"]
