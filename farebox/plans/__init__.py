"""Whole queries (Q1-Q6 and their API/format variants).

``q1``: hourly mean pickup position; ``q2``: longest trip per vendor;
``zones``: same-borough trips, night trips, top zone pairs, revenue per borough.
"""

from farebox.plans import q1, q2, zones

__all__ = ["q1", "q2", "zones"]
