"""Allele-specific DNA methylation calling on Spark DataFrames."""

from strandfold.params import AsmParams

__version__ = "0.2.0"

__all__ = ["AsmParams"]
