"""The profile of a table as named report frames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.columns import numeric_cols, text_cols
from ..operators import association, distributions, hypothesis, profile


def profile_table(df: DataFrame, target: str | None = None, fit_distributions: bool = False) -> dict[str, DataFrame]:
    """Basic profile, correlation, association, entropy and target reports.

    Frames are lazy: each is one or two grouped passes when it is read. A table
    without numeric or without text columns skips the reports that need them.
    """
    nums, texts = numeric_cols(df, [target] if target else ()), text_cols(df, [target] if target else ())
    out = {"basic": profile.basic_profile(df), "missingness": profile.missingness(df)}
    if nums:
        out |= {"numeric": profile.describe_numeric(df, nums), "moments": profile.shape_moments(df, nums), "normality": hypothesis.normality(df, nums), "intervals": hypothesis.normal_intervals(df, nums)}
    if len(nums) > 1:
        out["correlation"] = profile.pearson_pairs(df, nums)
    if texts:
        out |= {"text": profile.describe_text(df, texts), "cardinality": profile.cardinality(df, cols=texts)}
    if len(texts) > 1:
        out |= {"cramers_v": association.cramers_v(df, texts), "theils_u": association.theils_u(df, texts)}
    out["entropy"] = association.entropy_nats(df, [*nums, *texts])
    if target is not None:
        out["mutual_information"] = association.mutual_information(df, target, [*nums, *texts])
        if not association.is_regression(df, target) and nums:
            out["anova"] = association.anova_f(df, target, nums)
    if fit_distributions and nums:
        out["fits"] = distributions.best_fit(df, nums)
    return out
