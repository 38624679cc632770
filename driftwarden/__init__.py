"""Model monitoring and feature engineering as Spark DataFrame operators."""

from driftwarden.spec import ModelSpec

__all__ = ["ModelSpec"]
