"""forecourt: a Spark-native service-analytics library.

Raw, all-text extracts are landed as partitioned Parquet, cleaned with reusable
Catalyst column expressions, collapsed to current state, joined to
date-effective rates, priced and costed, and published as marts together with
data-quality checks and quarantine tables.  Every operator is a
``DataFrame -> DataFrame`` function so Catalyst sees one plan end to end.
"""

from forecourt.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
