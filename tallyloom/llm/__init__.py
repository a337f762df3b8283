"""Operators for preparing training data, their queries and SQL twins."""

from tallyloom.llm import caps, codes, graphs, language, licenses, packing, pages, pieces, quality, rules, simhash, substrings, whitening

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_graphs": graphs.op2_graphs,
    "op3_caps": caps.op3_caps,
    "op4_quality": quality.op4_quality,
    "op5_packing": packing.op5_packing,
    "op6_licenses": licenses.op6_licenses,
    "op7_pages": pages.op7_pages,
    "op8_substrings": substrings.op8_substrings,
    "op9_language": language.op9_language,
    "op10_pieces": pieces.op10_pieces,
    "op11_whitening": whitening.op11_whitening,
    "op12_rules": rules.op12_rules,
    "op13_codes": codes.op13_codes,
}
ORACLES = {
    "op6_licenses": licenses.OP6_SQL,
    "op8_substrings": substrings.OP8_SQL,
    "op12_rules": rules.OP12_SQL,
    "op13_codes": codes.OP13_SQL,
}
