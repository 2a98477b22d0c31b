from .clinical import ClinicalTables, from_driver_tables, from_tables
from .materialize import materialize, shared_folder
from .readers import coerce_numeric, drop_unlabelled, load_data, split_features_target
from .sinks import write_csv, write_json, write_parquet

__all__ = [
    "ClinicalTables",
    "from_driver_tables",
    "from_tables",
    "materialize",
    "shared_folder",
    "load_data",
    "coerce_numeric",
    "drop_unlabelled",
    "split_features_target",
    "write_csv",
    "write_json",
    "write_parquet",
]
