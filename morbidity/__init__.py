"""Patient-by-year illness panels from event-level health records, on Spark."""

from morbidity.config import Config

__all__ = ["Config"]
