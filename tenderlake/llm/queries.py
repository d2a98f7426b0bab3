"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from . import alignment, bpe, chat, langid, linededup, media, neardup, neural, packing, secrets, spelling, topk, warc

QUERIES = {
    "op2_revisit_resolution": warc.op2_revisit_resolution,
    "op3_maxscore": topk.op3_maxscore,
    "op4_telephony_audio": media.op4_telephony_audio,
    "op10_secret_forest": secrets.op10_secret_forest,
    "op1_crf_language": langid.op1_crf_language,
    "op7_minhash_hamming": neardup.op7_minhash_hamming,
    "op8_minimum_bin_slack": packing.op8_minimum_bin_slack,
    "op9_bpe_round_trip": bpe.op9_bpe_round_trip,
    "op5_prefix_target": chat.op5_prefix_target,
    "op6_line_dedup": linededup.op6_line_dedup,
    "op11_log_bilinear": neural.op11_log_bilinear,
    "op12_anagram_variants": spelling.op12_anagram_variants,
    "op13_token_alignment": alignment.op13_token_alignment,
}

SQL = {
    "op2_revisit_resolution": warc.OP2_SQL,
    "op3_maxscore": topk.OP3_SQL,
    "op7_minhash_hamming": neardup.OP7_SQL,
    "op5_prefix_target": chat.OP5_SQL,
    "op6_line_dedup": linededup.OP6_SQL,
    "op12_anagram_variants": spelling.OP12_SQL,
}
