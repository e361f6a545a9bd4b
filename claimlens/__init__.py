"""Claim-billing reports as Spark DataFrame functions."""

from claimlens.session import configure, tune
from claimlens.sources.tables import Tables

__all__ = ["Tables", "configure", "tune"]
