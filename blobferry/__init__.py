"""blobferry: move binary documents between object storage and tables with Spark.

Every job is a set of plain DataFrame functions. Progress, failures and
deletions are append-only ledgers (Parquet tables), so a run can be repeated
safely and reports what it did.
"""

from blobferry.session import get_session, scratch_path, state_root

__all__ = ["get_session", "scratch_path", "state_root"]
