"""Training rows with every feature as a small whole number, found and written once.

The bins of a numeric feature hold about equally many rows: the rows of each feature are ranked
by ranges (`ranks.with_group_place`), a rank's share of all rows is its bin, and the largest value of a
bin is its upper edge. A missing value is a bin of its own, so trees split it off without a flag column.
Text features are numbered in alphabetical order. Edges and labels are small whatever the data:
at most `bins` numbers for each numeric feature, and the distinct labels.

The table is written once and read by every fit. It is dealt into parts of many rows, since a boosted
fit runs several short jobs per round over all parts.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer, StringIndexerModel, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.operators.ranks import with_group_place
from fieldmart.session import materialized

#: Rows of a part at least, so that a round's jobs have few tasks on small data and enough on large.
PART_ROWS = 100_000


@dataclass(frozen=True)
class Binning:
    """Upper edges of the numeric features' bins, and the fitted numbering of the text features."""

    edges: dict[str, list[float]]
    indexer: StringIndexerModel | None
    texts: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f"{c}_index" for c in self.texts] + [f"{c}_bin" for c in self.edges]

    @property
    def largest(self) -> int:
        """Bins of the feature that has the most, with one for unknown labels."""
        labels = max((len(found) for found in self.indexer.labelsArray), default=0) if self.indexer else 0
        return max([labels + 1, *(len(e) + 2 for e in self.edges.values())])

    def apply(self, df: DataFrame) -> DataFrame:
        """Add the feature columns: bin 0 is a missing value, bin i holds the values up to edge i and above edge i - 1."""
        numeric = [c for c, e in self.edges.items() if e]  # a feature of one value has one bin
        # the bucketizer's ranges are closed below, the bins above; so both are negated
        value = {c: F.when(~F.isnan(c), F.col(c)).cast("double") for c in self.edges}
        turned = df.withColumns({f"_n_{c}": -v for c, v in value.items()})
        cuts = [[-math.inf, *sorted({-e for e in self.edges[c]}), math.inf] for c in numeric]
        stages = [self.indexer] if self.indexer else []
        if numeric:
            stages.append(Bucketizer(splitsArray=cuts, inputCols=[f"_n_{c}" for c in numeric], outputCols=[f"_b_{c}" for c in numeric],
                                     handleInvalid="keep"))
        out = PipelineModel(stages).transform(turned)
        bins = {c: F.lit(float(len(cut) - 1)) - F.col(f"_b_{c}") for c, cut in zip(numeric, cuts, strict=True)}
        out = out.withColumns({f"{c}_bin": F.when(F.col(f"_n_{c}").isNull(), 0.0).otherwise(bins.get(c, F.lit(1.0))) for c in self.edges})
        return out.drop(*[f"_n_{c}" for c in self.edges], *[f"_b_{c}" for c in numeric])


def feature_edges(rows: DataFrame, numeric: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Upper edges of at most `bins` bins of about equally many rows per feature, all but the last."""
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in numeric]).unpivot([], list(numeric), "feature", "value")
    present = long.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    ranked = with_group_place(present, ["feature"], ["value"], "place", size="n")
    share = F.floor(F.col("place") * bins / F.col("n")).alias("bin")
    uppers = ranked.groupBy("feature", share).agg(F.max("value").alias("edge")).select("feature", "edge").distinct().collect()
    edges = {c: sorted(r["edge"] for r in uppers if r["feature"] == c) for c in numeric}
    return {c: e[:-1] for c, e in edges.items()}


def fit_bins(rows: DataFrame, numeric: Sequence[str], texts: Sequence[str] = (), bins: int = 256) -> Binning:
    indexer = StringIndexer(inputCols=list(texts), outputCols=[f"{c}_index" for c in texts], stringOrderType="alphabetAsc",
                            handleInvalid="keep").fit(rows) if texts else None
    return Binning(feature_edges(rows, numeric, bins - 1), indexer, tuple(texts))


def binned_table(rows: DataFrame, binning: Binning, part_rows: int = PART_ROWS) -> DataFrame:
    """The rows with their features as 16-bit numbers, written, in parts of about `part_rows` rows.

    The order inside a part is that of a hash of the row, so that a fit is the same in every run.
    """
    wide = binning.largest > 32_000
    kept = binning.apply(rows).withColumns({c: F.col(c).cast("int" if wide else "smallint") for c in binning.columns})
    kept = materialized(kept, "binned")
    parts = max(1, math.ceil(kept.count() / part_rows))
    spread = F.xxhash64(*[c for c, kind in kept.dtypes if not kind.startswith(("map", "array", "struct"))])
    return materialized(kept.repartition(parts, spread).sortWithinPartitions(spread), "binned-parts")


def as_vector(df: DataFrame, binning: Binning, column: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=binning.columns, outputCol=column).transform(df)

