from storelens.sources.star import Star, TableStar, read_csv_bundle, read_csv_star, read_parquet_star
from storelens.sources.mapped import MappedStar

__all__ = ["Star", "TableStar", "MappedStar", "read_csv_bundle", "read_csv_star", "read_parquet_star"]
