"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hindcast.llm.cascade import OP11_SQL, op11_quality_rules
from hindcast.llm.jaccard import OP6_SQL, op6_jaccard
from hindcast.llm.language import op4_language
from hindcast.llm.licenses import op7_licenses
from hindcast.llm.line_dedup import OP1_SQL, op1_line_dedup
from hindcast.llm.ogg import op5_ogg
from hindcast.llm.packing import op2_packing
from hindcast.llm.pii import op10_pii
from hindcast.llm.quality import op3_quality
from hindcast.llm.repair import OP12_SQL, op12_repair
from hindcast.llm.tiling import op8_decontamination
from hindcast.llm.toxicity import op9_toxicity
from hindcast.llm.whitening import op13_whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_language": op4_language,
    "op5_ogg": op5_ogg,
    "op6_jaccard": op6_jaccard,
    "op7_licenses": op7_licenses,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_quality_rules": op11_quality_rules,
    "op12_repair": op12_repair,
    "op13_whitening": op13_whitening,
}

SQL: dict[str, str] = {"op1_line_dedup": OP1_SQL, "op6_jaccard": OP6_SQL, "op11_quality_rules": OP11_SQL, "op12_repair": OP12_SQL}
