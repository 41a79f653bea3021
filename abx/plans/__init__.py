from abx.plans.analysis import ExperimentAnalysis

__all__ = ["ExperimentAnalysis"]
