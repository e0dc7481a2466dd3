"""Training preparation: split, then impute, scale, treat and encode with plans fitted on the training part.

Each fit is a few aggregates over the training rows and ends in a small plan
table. The split, the filled and the scaled training rows and the prepared parts
are each computed once and read by all later steps. Plans are written once and can be reloaded for scoring.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import numeric_cols, text_cols
from ..operators import encode, impute, outliers, scale, splits
from ..session import cut_lineage

PARTS = ("train", "val", "test")


@dataclass
class Preparation:
    """Fitted plan tables of one run; ``donors`` are the training rows for drawing fills."""

    key: str
    impute_plan: DataFrame
    scale_plan: DataFrame
    fences: DataFrame
    onehot: dict[str, list]
    donors: DataFrame | None = None

    def apply(self, df: DataFrame, winsorize: bool = False) -> DataFrame:
        out = impute.apply_plan(df, self.impute_plan, self.key, self.donors)
        out = scale.apply_plan(out, self.scale_plan)
        if winsorize:
            out = outliers.winsorize(out, self.fences)
        return encode.one_hot(out, list(self.onehot), self.onehot) if self.onehot else out

    def save(self, folder: str) -> None:
        for name, plan in (("impute", self.impute_plan), ("scale", self.scale_plan), ("fences", self.fences)):
            plan.write.mode("overwrite").parquet(f"{folder}/{name}")
        spark = self.impute_plan.sparkSession
        rows = [(c, [str(v) for v in vs]) for c, vs in self.onehot.items()]
        spark.createDataFrame(rows, "feature string, levels array<string>").write.mode("overwrite").parquet(f"{folder}/onehot")

    @classmethod
    def load(cls, spark: SparkSession, folder: str, key: str, donors: DataFrame | None = None) -> Preparation:
        read = lambda name: spark.read.parquet(f"{folder}/{name}")
        hot = {r["feature"]: list(r["levels"]) for r in read("onehot").collect()}
        return cls(key, read("impute"), read("scale"), read("fences"), hot, donors)


def prepare(df: DataFrame, key: str, target: str, numeric: Sequence[str] | None = None, seed: int = 42) -> tuple[dict[str, DataFrame], Preparation]:
    """The three prepared parts and the fitted plans."""
    marked = cut_lineage(splits.stratified_split(df, key, target, seed=seed))
    parts = {p: marked.filter(F.col("split") == p).drop("split") for p in PARTS}
    train = parts["train"]
    features = [c for c in df.columns if c not in (key, target)]
    plan = impute.fit_plan(train.select(key, *features), key, seed=seed)
    filled = cut_lineage(impute.apply_plan(train, plan, key, train, seed))
    nums = [c for c in (numeric or numeric_cols(filled, [key, target])) if c in filled.columns]
    scaling = scale.fit_plan(filled, nums)
    scaled = cut_lineage(scale.apply_plan(filled, scaling))
    fences = outliers.fit_fences(scaled, nums)
    cats = text_cols(filled, [target])
    hot = {}
    if cats:
        routes = encode.route_encoders(filled, cats).collect()
        hot = {r["feature"]: encode.levels_of(filled, r["feature"]) for r in routes if r["linear"] == "onehot"}
    fitted = Preparation(key, plan, scaling, fences, hot, train)
    return {p: cut_lineage(fitted.apply(frame, winsorize=p == "train")) for p, frame in parts.items()}, fitted
