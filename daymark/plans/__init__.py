"""Multi-step runs that read, check, write and publish."""

from daymark.plans.pipeline import (extend_profile, ingest_payloads, load_star, prepare_features, profile,
                                    refresh_serving, validate)

__all__ = ["extend_profile", "ingest_payloads", "load_star", "prepare_features", "profile", "refresh_serving",
           "validate"]
