"""From raw documents to packed sequences; the stages are those of lakeshift.llm.pipeline."""

from lakeshift.llm.pipeline import ORACLE_SQL, STAGES, run  # noqa: F401
