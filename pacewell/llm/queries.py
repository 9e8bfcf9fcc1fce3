"""The queries of this subpackage and their SQL."""

from pacewell.llm import bpe, language, lines, merkle, mixing, neardup, negatives, packing, quality, recount, tokenfiles, topk, vectorcodes

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_quality": quality.op2_quality,
    "op3_token_files": tokenfiles.op3_token_files,
    "op4_packing": packing.op4_packing,
    "op5_token_counts": recount.op5_token_counts,
    "op6_top_k": topk.op6_top_k,
    "op7_near_duplicates": neardup.op7_near_duplicates,
    "op8_language": language.op8_language,
    "op9_fingerprints": merkle.op9_fingerprints,
    "op10_mixing": mixing.op10_mixing,
    "op11_bpe": bpe.op11_bpe,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_vector_codes": vectorcodes.op13_vector_codes,
}

ORACLES: dict[str, str] = {
    "op6_top_k": topk.OP6_SQL,
    "op9_fingerprints": merkle.OP9_SQL,
    "op12_hard_negatives": negatives.OP12_SQL,
}
