"""abx: experiment (A/B test) analytics as Spark DataFrame jobs.

Functions take and return DataFrames; nothing data-sized is collected.
"""

from abx.config import Experiment

__all__ = ["Experiment"]
