"""gainkit: information-gain-ratio classification trees as Spark DataFrame jobs."""

from gainkit.spec import FeatureSpec, infer_spec
from gainkit.operators.impurity import entropy, info_gain, intrinsic_value, gain_ratio
from gainkit.operators.split_search import best_threshold, split_candidates, rank_splits, best_split
from gainkit.operators.tree import fit, TreeModel
from gainkit.operators.score import route, predict, accuracy
from gainkit.operators.prune import prune
from gainkit.operators.sampling import hash_split, random_split, exact_split, kfold_assign
from gainkit.operators.evaluate import repeated_holdout

__all__ = [
    "FeatureSpec", "infer_spec",
    "entropy", "info_gain", "intrinsic_value", "gain_ratio",
    "best_threshold", "split_candidates", "rank_splits", "best_split",
    "fit", "TreeModel", "route", "predict", "accuracy", "prune",
    "hash_split", "random_split", "exact_split", "kfold_assign",
    "repeated_holdout",
]
