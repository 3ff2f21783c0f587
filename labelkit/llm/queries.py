"""All registered queries of this package."""

from labelkit.llm import queries_corpus, queries_documents, queries_vectors  # noqa: F401
from labelkit.llm.registry import ORACLES, QUERIES  # noqa: F401
