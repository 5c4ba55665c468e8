"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from genoweave.llm import chat, decontaminate, langid, licenses, linededup, negatives, packing, secrets, sharding, simhash, sketches, substrings, variants

QUERIES = {
    "op1_fingerprints": sketches.op1_fingerprints,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_packing": packing.op3_packing,
    "op4_simhash": simhash.op4_simhash,
    "op5_line_dedup": linededup.op5_line_dedup,
    "op6_language": langid.op6_language,
    "op7_substrings": substrings.op7_substrings,
    "op8_secrets": secrets.op8_secrets,
    "op9_licenses": licenses.op9_licenses,
    "op10_sharding": sharding.op10_sharding,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_chat_formatting": chat.op12_chat_formatting,
    "op13_spelling_variants": variants.op13_spelling_variants,
}
ORACLES: dict[str, str] = {
    "op2_decontamination": decontaminate.SQL,
    "op5_line_dedup": linededup.SQL,
    "op9_licenses": licenses.SQL,
    "op10_sharding": sharding.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op12_chat_formatting": chat.SQL,
    "op13_spelling_variants": variants.SQL,
}
