"""Query keys of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from . import ann, bpe, fmindex, langid, linedup, lm, mixing, oracle, parity, quality, repair, suffix, warc, whitening


def queries() -> dict[str, Callable]:
    return {
        "op1_suffix_dedup": suffix.op1_suffix_dedup,
        "op2_language_id": langid.op2_language_id,
        "op3_temperature_mixing": mixing.op3_temperature_mixing,
        "op4_fm_index_dedup": fmindex.op4_fm_index_dedup,
        "op5_bpe": bpe.op5_bpe,
        "op6_robust_graph": ann.op6_robust_graph,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_warc_index": warc.op8_warc_index,
        "op9_parity_join": parity.op9_parity_join,
        "op10_line_alignment": linedup.op10_line_alignment,
        "op11_path_ranking": repair.op11_path_ranking,
        "op12_elias_fano_trie": lm.op12_elias_fano_trie,
        "op13_spectrum_slicing": whitening.op13_spectrum_slicing,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
