"""fieldlens: Spark-native seasonal yield and weather analytics.

Every public function takes and returns DataFrames; nothing is pulled to the
driver except scalars (row counts, a handful of quantile ranks) and model
metadata of bounded size.
"""

from fieldlens.session import get_session, shared_path

__all__ = ["get_session", "shared_path"]
