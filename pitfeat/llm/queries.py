"""All queries of this folder and the SQL of those that SQL can express."""

from pitfeat.llm import chunk_bpe, collocations, conversation_trie, factorisation, licence_scan, line_dedup, mixing, pitman_yor, quality_rules, simhash, sketch, token_files, url_filter  # noqa: F401
from pitfeat.llm.common import ORACLE, QUERIES  # noqa: F401
