"""Registered queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline
from riskframe.llm import op1_minhash as op1
from riskframe.llm import op2_line_dedup as op2
from riskframe.llm import op6_dual_tree as op6
from riskframe.llm import op9_mixing as op9
from riskframe.llm import op10_decontamination as op10
from riskframe.llm import op11_shallot as op11
from riskframe.llm import op13_lemp as op13
from riskframe.llm.op3_token_records import op3_token_records
from riskframe.llm.op4_resampling import op4_resampling
from riskframe.llm.op5_url_rules import op5_url_rules
from riskframe.llm.op7_toxicity import op7_toxicity
from riskframe.llm.op8_chat_repair import op8_chat_repair
from riskframe.llm.op12_packing import op12_packing

QUERIES = {
    "op1_minhash": op1.op1_minhash,
    "op2_line_dedup": op2.op2_line_dedup,
    "op3_token_records": op3_token_records,
    "op4_resampling": op4_resampling,
    "op5_url_rules": op5_url_rules,
    "op6_dual_tree": op6.op6_dual_tree,
    "op7_toxicity": op7_toxicity,
    "op8_chat_repair": op8_chat_repair,
    "op9_mixing": op9.op9_mixing,
    "op10_decontamination": op10.op10_decontamination,
    "op11_shallot": op11.op11_shallot,
    "op12_packing": op12_packing,
    "op13_lemp": op13.op13_lemp,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_minhash": op1.ORACLE,
    "op2_line_dedup": op2.ORACLE,
    "op6_dual_tree": op6.ORACLE,
    "op9_mixing": op9.ORACLE,
    "op10_decontamination": op10.ORACLE,
    "op11_shallot": op11.ORACLE,
    "op13_lemp": op13.ORACLE,
}
