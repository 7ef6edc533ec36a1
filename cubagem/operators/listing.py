"""Listings of a catalog: surveys, cubes, variables, classifications, periods, requests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubagem.catalog import Catalog
from cubagem.functions.periods import parse_date
from cubagem.operators.flatten import flatten_surveys


def list_surveys(index: DataFrame) -> DataFrame:
    """Surveys with their number of cubes; a survey may be spread over several index rows."""
    return index.groupBy(F.col("id").alias("pesquisa_id"), F.col("nome").alias("pesquisa")).agg(
        F.sum(F.size("agregados")).alias("n_agregados")
    )


def list_survey_cubes(index: DataFrame, survey_id: str | int, check: bool = False) -> DataFrame:
    """Cubes of one survey. With ``check`` an unknown survey is an error, at once."""
    found = index.where(F.col("id") == str(survey_id))
    if check and found.isEmpty():
        raise ValueError(f"pesquisa não encontrada: {survey_id}")
    return flatten_surveys(found)


def cube_info_variables(catalog: Catalog) -> DataFrame:
    return catalog.variables.select("agregado_id", "ord", "var_id", "nome", "unidade")


def cube_info_classifications(catalog: Catalog) -> DataFrame:
    """Classifications with their number of categories."""
    counts = catalog.categories.groupBy("agregado_id", "class_id").agg(
        F.count("*").alias("n_categorias")
    )
    return (
        catalog.classifications.join(counts, ["agregado_id", "class_id"], "left")
        .na.fill(0, ["n_categorias"])
        .select("agregado_id", "ord", "class_id", "nome", "n_categorias")
    )


def cube_periods(catalog: Catalog) -> DataFrame:
    """Periods with their first literal as name and their modification date."""
    return catalog.periods.select(
        "agregado_id",
        "ord",
        "per_id",
        F.get("literals", F.lit(0)).alias("nome"),
        parse_date(F.col("modificacao")).alias("modificacao"),
    )


def parse_selection_lists(df: DataFrame, text: str, dim: str) -> DataFrame:
    """``a, b`` texts to rows (agregado_id, dim, class_id, id); a blank text restricts nothing."""
    items = F.explode(F.split(F.col(text), ","))
    return (
        df.select("agregado_id", F.lit(dim).alias("dim"), items.alias("_i"))
        .select(
            "agregado_id",
            "dim",
            F.lit(None).cast("string").alias("class_id"),
            _strip("_i").alias("id"),
        )
        .where("id <> ''")
    )


def parse_class_selections(df: DataFrame, text: str) -> DataFrame:
    """``ID=cat1,cat2`` texts to rows; without categories the row has a null id."""
    parts = df.select(
        "agregado_id",
        F.lit("classificacao").alias("dim"),
        _strip(F.substring_index(text, "=", 1)).alias("class_id"),
        F.filter(
            F.transform(F.split(F.regexp_extract(text, r"(?s)=(.*)$", 1), ","), _strip),
            lambda item: item != "",
        ).alias("_ids"),
    )
    return parts.select("agregado_id", "dim", "class_id", F.explode_outer("_ids").alias("id"))


def _strip(column):
    return F.regexp_replace(column, r"(?U)^\s+|\s+$", "")
