"""Tabular baseline analytics on Spark: clean, derive, profile, select, explain."""

from .operators.boruta import boruta
from .operators.cleaning import (
    StageAudit,
    apply_featurizers,
    assemble_columns,
    clean,
    drop_columns,
    drop_unlabeled,
    dropna_keys,
    failed_casts,
    featurizer,
    select_features,
)
from .operators.comparison import binned_mi, compare_subsets, leaderboard
from .operators.encoding import (
    BaseNEncoder,
    OneHotEncoder,
    OrdinalEncoder,
    Preprocessor,
    Standardizer,
    auto_encode,
    base_n_encode,
    cardinality,
    decode,
    distinct_values,
    fit_categories,
    onehot_encode,
    ordinal_encode,
    standardize,
)
from .operators.exact_tree import exact_tree
from .operators.explain import explain_tree, tree_nodes, tree_rules
from .operators.frontier import pareto_front, pareto_front_of
from .operators.gram import Ridge
from .operators.groups import count_by, mean_by
from .operators.histograms import (
    facet_bins,
    facet_grid_width,
    histogram,
    pairwise_scatter,
    pairwise_stats,
    scatter_bins,
    scatter_points,
    scatter_stats,
)
from .operators.information import drop_uninformative, maximal_information
from .operators.metrics import METRICS, Metric, mean_score, score
from .operators.models import FAMILIES, ModelFamily, fit_model
from .operators.polynomial import poly_full, poly_interactions
from .operators.profiling import (
    associations,
    compare_segments,
    profile,
    profile_categorical,
    profile_numeric,
    target_correlation,
    top_values,
    univariate_profile,
)
from .operators.quantiles import QuantileBand, exact_quantiles, quantile_band
from .operators.segments import cluster_profile, ridge_tree, segment_ridge, useful_segments
from .operators.splits import fold_sizes, holdouts, kfold, repeated_kfold
from .operators.subsets import subset_search, subset_search_log
from .operators.tuning import tune
from .sources.tables import (
    StageFolders,
    read_mapping,
    read_table,
    selected_features,
    write_feature_sets,
    write_mapping,
    write_product,
    write_selection,
    write_table,
)
from .spec import TableSpec

__all__ = [name for name in dir() if not name.startswith("_")]
