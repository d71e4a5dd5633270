"""The corpus operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from inkmill.llm import balltree, bpe, chat, collocations, hosts, jaccard, lexical, licenses, lines, mixing, passages, rules, suffixes

QUERIES = {
    "op1_mix": mixing.query,
    "op2_quality_rules": rules.query,
    "op3_license_scan": licenses.query,
    "op4_topk": balltree.query,
    "op5_jaccard_join": jaccard.query,
    "op6_line_dedup": lines.query,
    "op7_bpe": bpe.query,
    "op8_passages": passages.query,
    "op9_suffix_dedup": suffixes.query,
    "op10_url_filter": hosts.query,
    "op11_chat_format": chat.query,
    "op12_lexical_search": lexical.query,
    "op13_collocations": collocations.query,
}

ORACLES = {
    "op1_mix": mixing.ORACLE,
    "op2_quality_rules": rules.ORACLE,
    "op3_license_scan": licenses.ORACLE,
    "op4_topk": balltree.ORACLE,
    "op6_line_dedup": lines.ORACLE,
    "op10_url_filter": hosts.ORACLE,
    "op11_chat_format": chat.ORACLE,
    "op12_lexical_search": lexical.ORACLE,
    "op13_collocations": collocations.ORACLE,
}
