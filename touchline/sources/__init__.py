from touchline.sources.schemas import SCHEMAS
from touchline.sources.tables import infer_csv, load_inputs, load_table, write_csv, write_parquet

__all__ = ["SCHEMAS", "infer_csv", "load_inputs", "load_table", "write_csv", "write_parquet"]
