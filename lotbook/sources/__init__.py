from lotbook.sources.raw import load_raw, raw_drops, read_raw
from lotbook.sources.tables import Warehouse

__all__ = ["Warehouse", "load_raw", "raw_drops", "read_raw"]
