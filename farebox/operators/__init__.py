"""Relational building blocks (``DataFrame -> DataFrame``)."""

from farebox.operators.aggregates import avg_by, count_by, max_by_key, mean_from_sums, sum_by
from farebox.operators.argmax import argmax_first, argmax_ties, argmax_window
from farebox.operators.joins import fits_broadcast, lookup_join, lookup_side, role_playing_join
from farebox.operators.ordering import head, sort_asc, sort_desc, top_k

__all__ = [
    "argmax_first", "argmax_ties", "argmax_window", "avg_by", "count_by", "fits_broadcast", "head",
    "lookup_join", "lookup_side", "max_by_key", "mean_from_sums", "role_playing_join", "sort_asc",
    "sort_desc", "sum_by", "top_k",
]
