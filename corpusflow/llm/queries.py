"""The queries of the training-data operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chunks, collisions, decontaminate, licenses, lines, maintext, mixing, packing, phrases, quality, retrieval, simhash, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_collisions": collisions.op1_collisions,
    "op2_suffixes": suffixes.op2_suffixes,
    "op3_simhash": simhash.op3_simhash,
    "op4_pack": packing.op4_pack,
    "op5_licenses": licenses.op5_licenses,
    "op6_quality": quality.op6_quality,
    "op7_chunks": chunks.op7_chunks,
    "op8_mixing": mixing.op8_mixing,
    "op9_decontaminate": decontaminate.op9_decontaminate,
    "op10_lines": lines.op10_lines,
    "op11_main_text": maintext.op11_main_text,
    "op12_phrases": phrases.op12_phrases,
    "op13_search": retrieval.op13_search,
}

ORACLES: dict[str, str] = {
    "op1_collisions": collisions.ORACLE_SQL,
    "op2_suffixes": suffixes.ORACLE_SQL,
    "op9_decontaminate": decontaminate.ORACLE_SQL,
    "op10_lines": lines.ORACLE_SQL,
    "op12_phrases": phrases.ORACLE_SQL,
    "op13_search": retrieval.ORACLE_SQL,
}
