"""Record linkage and data preparation on Spark."""

from kinfold.operators.cleaning import VOTER_RULES, apply_cleaning, clean_voters
from kinfold.operators.clusters import connected_components, multi_source_report
from kinfold.operators.comparison import Comparison, exact, similar
from kinfold.operators.identity import (
    add_hash_ids,
    add_sequential_ids,
    add_uuid_ids,
    sample_exactly,
)
from kinfold.operators.mapping import (
    apply_mapping,
    mapping_problems,
    union_all_by_name,
)
from kinfold.operators.schema_log import diff_schemas, extract_schema
from kinfold.plans.ingest import ingest_files
from kinfold.plans.match import MatchSettings, load_records, match_records
from kinfold.plans.prepare import prepare, prepare_files
from kinfold.session import build_session
from kinfold.sources.archives import read_archives
from kinfold.sources.delimited import read_delimited
from kinfold.sources.json_records import read_json
from kinfold.sources.loader import load_dataframe, read_parquet
from kinfold.streaming.incremental import run_incremental

__all__ = [
    "VOTER_RULES",
    "Comparison",
    "MatchSettings",
    "add_hash_ids",
    "add_sequential_ids",
    "add_uuid_ids",
    "apply_cleaning",
    "apply_mapping",
    "build_session",
    "clean_voters",
    "connected_components",
    "diff_schemas",
    "exact",
    "extract_schema",
    "mapping_problems",
    "ingest_files",
    "load_dataframe",
    "load_records",
    "match_records",
    "multi_source_report",
    "prepare",
    "prepare_files",
    "read_archives",
    "read_delimited",
    "read_json",
    "read_parquet",
    "run_incremental",
    "sample_exactly",
    "similar",
    "union_all_by_name",
]
