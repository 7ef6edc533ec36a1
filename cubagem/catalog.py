"""The normalised catalog that every operator works on."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubagem.session import own_step


@dataclass(frozen=True)
class Catalog:
    """One DataFrame per entity; every child row carries its position ``ord``, from 0.

    * ``cubes``: agregado_id, nome, url, pesquisa_id, pesquisa, assunto, frequencia, inicio, fim
    * ``levels``: agregado_id, grupo, nivel, ord (administrative, special, then ibge)
    * ``localities``: agregado_id, nivel, nivel_nome, loc_id, nome, ord (within cube and level)
    * ``variables``: agregado_id, var_id, nome, unidade, sumarizacao, ord
    * ``classifications``: agregado_id, class_id, nome, sumarizacao, ord
    * ``categories``: agregado_id, class_id, cat_id, nome, unidade, nivel, ord (within class)
    * ``periods``: agregado_id, per_id, literals, modificacao, ord
    """

    cubes: DataFrame
    levels: DataFrame
    localities: DataFrame
    variables: DataFrame
    classifications: DataFrame
    categories: DataFrame
    periods: DataFrame

    def save(self, path: str) -> None:
        """Write the tables as Parquet, one folder each."""
        for field in fields(Catalog):
            table = getattr(self, field.name)
            with own_step(table.sparkSession):
                table.write.parquet(f"{path}/{field.name}")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Catalog:
        """A saved catalog. Each table is read as it was written, so nothing is derived twice."""
        return Catalog(*(spark.read.parquet(f"{path}/{field.name}") for field in fields(Catalog)))

    def nested_cubes(self) -> DataFrame:
        """One row per cube with its variables and classifications as arrays.

        Both come from one metadata document, which bounds them. Localities do not
        and stay in their own table.
        """
        variables = ordered_array(
            self.variables,
            ["agregado_id"],
            "variaveis",
            F.col("var_id").alias("id"),
            "nome",
            "unidade",
            "sumarizacao",
        )
        categories = ordered_array(
            self.categories,
            ["agregado_id", "class_id"],
            "categorias",
            F.col("cat_id").alias("id"),
            "nome",
            "unidade",
            "nivel",
        )
        classifications = ordered_array(
            self.classifications.join(categories, ["agregado_id", "class_id"], "left"),
            ["agregado_id"],
            "classificacoes",
            F.col("class_id").alias("id"),
            "nome",
            "sumarizacao",
            F.coalesce(
                "categorias",
                F.array().cast(categories.schema["categorias"].dataType),
            ).alias("categorias"),
        )
        joined = self.cubes.join(variables, "agregado_id", "left").join(
            classifications, "agregado_id", "left"
        )
        empty = {
            "variaveis": F.array().cast(variables.schema["variaveis"].dataType),
            "classificacoes": F.array().cast(classifications.schema["classificacoes"].dataType),
        }
        return joined.withColumns(
            {name: F.coalesce(F.col(name), value) for name, value in empty.items()}
        )


def ordered_array(df: DataFrame, keys: list[str], name: str, *fields) -> DataFrame:
    """Collect ``fields`` per key into an array of structs in ``ord`` order.

    Only for groups bounded by a document or a batch size.
    """
    entry = F.struct("ord", F.struct(*fields).alias("valor"))
    return df.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["valor"]).alias(name)
    )
