"""Registered queries over the corpus tables, with the SQL that must give the same rows."""

from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

from . import decontamination, dialogues, fillmiddle, htmltext, langid, licenses, lmscore, mixing, neardup, paragraphs, suffixes, tokencounts, topk  # noqa: E402, F401
