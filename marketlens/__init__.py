"""marketlens: as-of-date seller feature tables for a marketplace, built on Spark.

Each feature group is a function from the conformed marketplace relations
(:class:`marketlens.sources.Marketplace`) to one wide row per seller and
reference date.  Everything is a lazy DataFrame; nothing is collected.
"""

from marketlens.sources.marketplace import Marketplace

__all__ = ["Marketplace"]
__version__ = "0.1.0"
