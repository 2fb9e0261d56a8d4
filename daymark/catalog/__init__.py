"""Registered queries, each with the SQL that gives the same rows."""

from daymark.catalog import (equality, features, plain, profiles, quality, scans, serving,
                             stars, summaries)
from daymark.catalog.base import REGISTRY

__all__ = ["REGISTRY", "equality", "features", "plain", "profiles", "quality", "scans",
           "serving", "stars", "summaries"]
