"""Design grid: every site x block x treatment plot with its ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..operators import reshape as R
from . import dictionaries as D
from ..sources.inline import inline_table


def design_grid(spark: SparkSession, sites: Sequence[str] = tuple(D.DESIGN_SITES),
                blocks: Sequence[int] = tuple(D.DESIGN_BLOCKS),
                treatments: Sequence[str] = tuple(D.DESIGN_TREATMENTS)) -> DataFrame:
    """12 x 4 x 8 = 384 plots; ``blockID`` = site code + block,
    ``plotID`` = blockID + treatment. Sorted like a crossing (at the sink)."""
    s = inline_table(spark, [(x,) for x in sites], "siteID string")
    return grid_from_sites(s, blocks, treatments).orderBy("siteID", "blockID", "treatment")


def grid_from_sites(sites: DataFrame, blocks: Sequence[int], treatments: Sequence[str]) -> DataFrame:
    g = R.expand_levels(sites.select("siteID"), {"blockID": list(blocks), "treatment": list(treatments)})
    g = g.withColumn("blockID", S.paste(S.r_substr("siteID", 1, 3), F.col("blockID")))
    return g.withColumn("plotID", S.paste("blockID", "treatment"))
