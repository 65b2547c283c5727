"""tripspark: ride-trip analytics on Spark DataFrames.

Layers: raw trip files -> curated (typed, validated) -> enriched with zones ->
daily borough / zone / service marts, plus data-quality reports, month-based
landing operators and an incremental (Structured Streaming) path whose result
equals one full batch run.
"""

from tripspark.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
