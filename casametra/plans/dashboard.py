"""Headline figures and scoped views over a written gold document."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from casametra.operators.filters import dashboard_scope
from casametra.operators.kpi import preferred_boxes, summary
from casametra.params import READABLE_GOLD_VERSIONS
from casametra.schemas import GOLD_DOCUMENT_SCHEMA
from casametra.sources.documents import dataset, read_document


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return read_document(spark, path, GOLD_DOCUMENT_SCHEMA, READABLE_GOLD_VERSIONS)


def block_datasets(doc: DataFrame, block_name: str) -> dict[str, DataFrame]:
    """All datasets of a block as DataFrames."""
    names = doc.schema[block_name].dataType.fieldNames()
    return {name: dataset(doc, block_name, name) for name in names}


def scoped_block(
    datasets: dict[str, DataFrame],
    districts: Sequence[str] = (),
    neighborhoods: Sequence[str] = (),
) -> dict[str, DataFrame]:
    return {
        name: dashboard_scope(df, districts, neighborhoods) for name, df in datasets.items()
    }


def headline_figures(doc: DataFrame, datasets: dict[str, DataFrame]) -> DataFrame:
    """One row of figures for a population block."""
    boxes = preferred_boxes(
        datasets["boxplot_by_neighborhood_last_3m"], datasets["boxplot_by_neighborhood"]
    )
    stamp = doc.select("generated_at").scalar()
    return summary(boxes, datasets["rent_vs_sale_ratio"], stamp)
