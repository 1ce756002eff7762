"""Cleansing, modelling and preprocessing of tables as Spark DataFrame operators."""

from quern.frames import Outcome, Splits

__all__ = ["Outcome", "Splits"]
