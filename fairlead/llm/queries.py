"""Registered queries of the document operators, one per operator.

op13_infill has SQL; the others cannot be written in SQL as a whole. tests/llm checks each against
brute force, an exact round trip or held-out accuracy.
"""

from __future__ import annotations

from fairlead.llm import infill
from fairlead.llm.alignment import op12_alignment
from fairlead.llm.decontaminate import op5_decontamination
from fairlead.llm.fingerprints import op7_fingerprints
from fairlead.llm.infill import op13_infill
from fairlead.llm.language import op1_language
from fairlead.llm.packing import op4_packing
from fairlead.llm.quality import op2_quality
from fairlead.llm.secrets import op9_secrets
from fairlead.llm.sharding import op6_sharding
from fairlead.llm.simhash import op3_simhash
from fairlead.llm.substrings import op8_substrings
from fairlead.llm.tokencounts import op10_token_counts
from fairlead.llm.toxicity import op11_toxicity

QUERIES = {
    "op1_language": op1_language,
    "op2_quality": op2_quality,
    "op3_simhash": op3_simhash,
    "op4_packing": op4_packing,
    "op5_decontamination": op5_decontamination,
    "op6_sharding": op6_sharding,
    "op7_fingerprints": op7_fingerprints,
    "op8_substrings": op8_substrings,
    "op9_secrets": op9_secrets,
    "op10_token_counts": op10_token_counts,
    "op11_toxicity": op11_toxicity,
    "op12_alignment": op12_alignment,
    "op13_infill": op13_infill,
}
ORACLE: dict[str, str] = {"op13_infill": infill.ORACLE_SQL}
