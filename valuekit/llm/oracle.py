"""DuckDB statements for the queries of this subpackage that SQL can express."""

from valuekit.llm import license, manifest, minhash, sigtree, substring, trie

ORACLE: dict[str, str] = {
    "op3_license": license.ORACLE_SQL,
    "op6_substring": substring.ORACLE_SQL,
    "op8_minhash": minhash.ORACLE_SQL,
    "op11_sigtree": sigtree.ORACLE_SQL,
    "op12_merkle": manifest.ORACLE_SQL,
    "op13_trie": trie.ORACLE_SQL,
}
