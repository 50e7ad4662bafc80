"""Operators for training-data corpora (quality, packing, dedup, decontamination, scans).

Executors need not have this package installed: its modules are pickled by
value with the functions that Spark ships to the Python workers.
"""

from __future__ import annotations

import importlib

from pyspark import cloudpickle

MODULES = ("common", "decontaminate", "quality_rules", "packing", "token_counts", "line_spread",
           "secret_scan", "recurrent", "toxicity", "latent_votes", "ngram_join", "suffix_dedup",
           "collocations", "token_alignment", "vantage_trees")

for _name in MODULES:
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
