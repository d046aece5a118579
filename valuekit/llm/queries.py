"""The queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from valuekit.llm.ann import op1_ann
from valuekit.llm.bpe import op5_bpe
from valuekit.llm.fingerprint import op2_fingerprint
from valuekit.llm.license import op3_license
from valuekit.llm.lm import op9_lm
from valuekit.llm.manifest import op12_merkle
from valuekit.llm.minhash import op8_minhash
from valuekit.llm.packing import op4_packing
from valuekit.llm.quality import op7_quality
from valuekit.llm.sigtree import op11_sigtree
from valuekit.llm.substring import op6_substring
from valuekit.llm.toxicity import op10_toxicity
from valuekit.llm.trie import op13_trie

QUERIES = {
    "op1_ann": op1_ann,
    "op2_fingerprint": op2_fingerprint,
    "op3_license": op3_license,
    "op4_packing": op4_packing,
    "op5_bpe": op5_bpe,
    "op6_substring": op6_substring,
    "op7_quality": op7_quality,
    "op8_minhash": op8_minhash,
    "op9_lm": op9_lm,
    "op10_toxicity": op10_toxicity,
    "op11_sigtree": op11_sigtree,
    "op12_merkle": op12_merkle,
    "op13_trie": op13_trie,
}
