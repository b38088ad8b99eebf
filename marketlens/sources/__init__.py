from marketlens.sources.marketplace import Marketplace, from_catalog, from_parquet
from marketlens.sources.testdata import load_testdata

__all__ = ["Marketplace", "from_catalog", "from_parquet", "load_testdata"]
