"""Streaming use of the operators.

The reference has no streaming operator (no watermarks, windows or state),
so nothing here is a new operator.  What a streaming user needs is to apply
the existing ones to ``readStream`` sources:

* the row-wise scorers (FM scoring, regression-table scoring, the scalar
  functions) are plain column expressions and run unchanged on a streaming
  DataFrame;
* operators that need whole tables (kNN against a trained table, top-N
  recommendation) run per micro-batch through ``foreachBatch``.
"""

from .micro_batch import apply_per_batch, score_stream  # noqa: F401
