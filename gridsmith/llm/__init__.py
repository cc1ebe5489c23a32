"""Operators for building text training corpora, as Spark jobs.

Thirteen operators (URL filters, language identification, SimHash near-duplicates,
edit-aware token counts, benchmark decontamination, quartile digests, source
mixing, packed token files, licence scans, toxicity, repeated passages, token
alignment, hard negatives) and the queries that apply
them to the given tables (``llm.queries``).  Nothing outside this package
imports it.
"""
