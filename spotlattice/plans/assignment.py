"""From spots, outlines and counts to cells: one stage that writes the whole set of tables."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import assign, geometry, matrix
from ..session import cut
from ..sources import tables


@dataclass
class Assigned:
    """spots: spot, x, y, spot_counts, assigned, cell_id (null: none); cells: cell_id, centroid_x, centroid_y, area_px2, n_spots; x: cell_id, gene, n;
    genes: gene and its columns, with counts and shares, and a unique name; yields: one row."""

    spots: DataFrame
    cells: DataFrame
    x: DataFrame
    genes: DataFrame
    yields: DataFrame

    def write(self, folder: str, notes: dict | None = None) -> None:
        """assignment_yield (JSON), per_spot_counts_assigned, spot_to_cell (-1: no cell), gene_assigned_fractions, gene_unassigned_top30 and cells_meta (CSV), and the bundle ``cells``."""
        spark = self.spots.sparkSession
        told = self.yields.first().asDict()
        spark.createDataFrame([(json.dumps(told, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/assignment_yield")
        tables.write_csv(self.spots.select("spot", "x", "y", "spot_counts", "assigned"), f"{folder}/per_spot_counts_assigned")
        tables.write_csv(self.spots.select("spot", "x", "y", F.coalesce("cell_id", F.lit(-1)).alias("cell_id")), f"{folder}/spot_to_cell")
        tables.write_csv(self.genes, f"{folder}/gene_assigned_fractions")
        tables.write_csv(matrix.top_unassigned(self.genes).select("gene_name", "total_counts", "unassigned_frac"), f"{folder}/gene_unassigned_top30")
        tables.write_csv(self.cells, f"{folder}/cells_meta")
        tables.write_bundle(f"{folder}/cells", self.x, self.cells, self.genes, {**(notes or {}), **told})


def assigned(spots: DataFrame, regions: DataFrame, counts: DataFrame, genes: DataFrame, size: float = 12.0, use_covers: bool = True) -> Assigned:
    """``spots``: spot (one row each), x, y; ``regions``: cell_id, edges; ``counts``: spot, gene, n; ``genes``: gene, gene_name.

    Counts of spots that are not listed are left out; spots without counts have 0, and count as spots.
    Cells without a spot and genes without a count stay, with 0. Names that come twice get a number in ``unique_name``.
    """
    held = cut(assign.assign_spots(spots.select("spot", "x", "y"), regions, size=size, use_covers=use_covers))
    place = cut(spots.select("spot", "x", "y").join(held, "spot", "left"))
    known = cut(counts.select("spot", "gene", "n").join(place.select("spot", F.col("cell_id").alias("cell")), "spot"))
    totals = known.groupBy("spot").agg(F.sum("n").alias("n"))
    per_spot = matrix.spot_table(place, totals, held).join(place.select("spot", "cell_id"), "spot")
    cx, cy = geometry.centroid(F.col("edges"))
    shape = regions.select("cell_id", cx.alias("centroid_x"), cy.alias("centroid_y"), F.abs(geometry.signed_area(F.col("edges"))).alias("area_px2"))
    cells = shape.join(held.groupBy("cell_id").agg(F.count(F.lit(1)).alias("n_spots")), "cell_id", "left").fillna(0, ["n_spots"])
    x = matrix.cell_gene_matrix(known.filter("cell is not null").withColumnRenamed("cell", "cell_id"), "cell_id")
    listed = matrix.unique_names(matrix.gene_yield(known, genes), "gene_name", "gene")
    has = F.col("cell_id").isNotNull()
    sums = per_spot.agg(
        F.count(F.lit(1)).alias("n_spots_total"), F.count_if(has).alias("n_spots_assigned"),
        F.coalesce(F.sum("spot_counts"), F.lit(0)).alias("counts_total"), F.coalesce(F.sum(F.when(has, F.col("spot_counts"))), F.lit(0)).alias("counts_assigned"),
    )
    yields = sums.select(
        "n_spots_total", "n_spots_assigned", F.try_divide("n_spots_assigned", "n_spots_total").alias("spots_assigned_frac"), "counts_total", "counts_assigned",
        (F.col("counts_total") - F.col("counts_assigned")).alias("counts_unassigned"), F.try_divide("counts_assigned", "counts_total").alias("counts_assigned_frac"),
    )
    return Assigned(per_spot, cells, x, listed, yields)
