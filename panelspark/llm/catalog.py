"""Registered queries of this folder: name -> function, name -> DuckDB SQL."""

from __future__ import annotations

import importlib

MODULES = ["token_files", "shards", "language", "cws", "simhash", "suffix_dedup", "pack", "segment_bpe", "ann", "licences",
           "importance", "hard_negatives", "flat_graph"]


def _all():
    return [importlib.import_module(f"panelspark.llm.{m}") for m in MODULES]


def queries():
    out = {k: v for m in _all() for k, v in vars(m).items() if k.startswith("op") and k[2:3].isdigit() and callable(v)}
    return dict(sorted(out.items(), key=lambda kv: int(kv[0][2:].split("_")[0])))


def oracle_sql():
    return {k: v for m in _all() for k, v in getattr(m, "ORACLE", {}).items()}
