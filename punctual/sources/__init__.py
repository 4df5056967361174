from punctual.sources.readers import read_csv, read_csv_header_only, read_table
from punctual.sources.schemas import AIRPORT, AIRPORT_ID, CARRIER, CLUSTER_MAP, COORDINATES, FLIGHTS, as_strings
from punctual.sources.sinks import result_rows, write_csv, write_table

__all__ = [
    "AIRPORT", "AIRPORT_ID", "CARRIER", "CLUSTER_MAP", "COORDINATES", "FLIGHTS", "as_strings", "read_csv",
    "read_csv_header_only", "read_table", "result_rows", "write_csv", "write_table",
]
