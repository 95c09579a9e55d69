"""Readers, writers and the seeded transaction generator."""

from ledgerloom.sources.bucketed import drop_bucketed, exchanges, write_bucketed
from ledgerloom.sources.generator import generate_transactions, transactions_for_ids
from ledgerloom.sources.parquet import land_run, read_raw, read_table, write_parquet
from ledgerloom.sources.quarantine import read_quarantine_csv, write_quarantine_csv
from ledgerloom.sources.retail_view import retail_view
from ledgerloom.sources.scratch import scratch_path
from ledgerloom.sources.triage import FileVerdict, read_accepted, rejected_files, triage_files
from ledgerloom.sources.versions import Commit, CommitConflict, Lake, Manifest

__all__ = [
    "Commit",
    "CommitConflict",
    "FileVerdict",
    "Lake",
    "Manifest",
    "drop_bucketed",
    "exchanges",
    "generate_transactions",
    "land_run",
    "read_accepted",
    "read_quarantine_csv",
    "read_raw",
    "read_table",
    "rejected_files",
    "retail_view",
    "scratch_path",
    "transactions_for_ids",
    "triage_files",
    "write_bucketed",
    "write_parquet",
    "write_quarantine_csv",
]
