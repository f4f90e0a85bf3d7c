"""Spark-native toolkit for building, judging and publishing binary-target scores."""

from scoreloom.roles import Roles

__all__ = ["Roles"]
__version__ = "0.1.0"
