"""Vehicle event and charge analytics on Spark DataFrames."""

from ampline.config import Params

__all__ = ["Params"]
