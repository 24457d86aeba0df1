"""starloom: dimensional analytics on Spark DataFrames.

Lands and conforms raw sources, removes duplicates and loads deltas by row
hash, resolves noisy codes and text through lookup maps, builds slowly
changing dimensions and summary facts, checks data quality and answers
report-style questions.  Every operator is a set-based DataFrame
transformation; the heavy lifting is left to Catalyst and AQE.
"""

from starloom.session import build_session, checkpoint_root, scratch_path

__all__ = ["build_session", "checkpoint_root", "scratch_path"]
