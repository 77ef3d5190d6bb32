"""bookpipe: incremental, resumable catalogue-and-review ingest on Spark."""

from bookpipe.config import RunConfig
from bookpipe.profile import SHOP, SiteProfile

__all__ = ["RunConfig", "SHOP", "SiteProfile"]
