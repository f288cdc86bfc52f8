"""DuckDB SQL for the registered queries of this subpackage that SQL can express.

The others are held against brute-force versions, exact round trips or
held-out accuracy in ``tests/llm``.
"""

from linefeed.llm import chat, filter_audit, prefix_trie

ORACLE: dict[str, str] = {"op8_chat": chat.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE,
                          "op13_filter_audit": filter_audit.ORACLE}
