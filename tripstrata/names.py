"""Column names and values shared by several modules."""

SOURCE_FILE = "_source_file"
INGEST_TIME = "_ingest_timestamp"

LABEL = "trip_type"

VERDICT = "is_valid_trip"
ROUTE = "_route"
CLEAN = "clean"
QUARANTINE = "quarantine"
