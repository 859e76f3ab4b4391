"""The queries of the training-data operators beside their SQL."""

from importlib import import_module

from lakeops.llm.common import ORACLE, QUERIES

MODULES = ("langid", "licences", "main_text", "line_dedup", "exact_dedup", "pieces", "near_dedup", "chat", "leaks", "warc", "repair", "suffix_tree", "phrases")

for _module in MODULES:
    import_module(f"lakeops.llm.{_module}")

__all__ = ["ORACLE", "QUERIES"]
