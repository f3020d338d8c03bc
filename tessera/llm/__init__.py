"""Operators for preparing training data.  Nothing else in the library imports this package."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from . import (base, op1_neighbours, op2_mixing, op3_language, op4_pii, op5_quality, op6_html, op7_substring, op8_lm,
               op9_packing, op10_jaccard, op11_phrases, op12_simhash, op13_conversations)

OPERATORS = {
    "op1_neighbours": op1_neighbours,
    "op2_mixing": op2_mixing,
    "op3_language": op3_language,
    "op4_pii": op4_pii,
    "op5_quality": op5_quality,
    "op6_html": op6_html,
    "op7_substring": op7_substring,
    "op8_lm": op8_lm,
    "op9_packing": op9_packing,
    "op10_jaccard": op10_jaccard,
    "op11_phrases": op11_phrases,
    "op12_simhash": op12_simhash,
    "op13_conversations": op13_conversations,
}

#: functions go to the executors by value, so workers need not have the package on their path
for _module in (base, *OPERATORS.values()):
    _cloudpickle.register_pickle_by_value(_sys.modules[_module.__name__])

QUERIES = {name: module.query for name, module in OPERATORS.items()}
ORACLE_SQL = {name: module.SQL for name, module in OPERATORS.items() if hasattr(module, "SQL")}
