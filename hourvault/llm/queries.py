"""All queries of this subpackage, with the SQL of those that SQL can express."""

from hourvault.llm import conversation_trie, decontaminate, hard_negatives, html_text, language_id, language_model, near_dedup, packing, quality, secret_scan, sharding, toxicity, warc  # noqa: F401
from hourvault.llm.registry import ORACLES as LLM_ORACLES  # noqa: F401
from hourvault.llm.registry import QUERIES as LLM_QUERIES  # noqa: F401
