"""Sizes of cubes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.catalog import Catalog


def locality_counts(localities: DataFrame) -> DataFrame:
    """Localities per cube and territorial level."""
    return localities.groupBy("agregado_id", "nivel").agg(F.count("*").alias("n_localidades"))


BIG = "decimal(38,0)"


def times(kind: str, *factors: Column) -> Column:
    """The product of whole numbers as ``kind``; null where it is too large for that, or a factor is null."""
    found = factors[0].cast(BIG)
    for factor in factors[1:]:
        found = F.try_multiply(found, factor.cast(BIG)).try_cast(BIG)
    return found.try_cast(kind)


def product(counts: Column, kind: str = "bigint") -> Column:
    """Product of an array of counts, 1 if it is empty; null if it is too large for ``kind``."""
    one, zero = F.lit(1).cast(BIG), F.lit(0).cast(BIG)
    found = F.aggregate(counts, one, lambda acc, n: F.try_multiply(acc, n.cast(BIG)).try_cast(BIG))
    return F.when(F.exists(counts, lambda n: n == 0), zero).otherwise(found).try_cast(kind)


def category_counts(catalog: Catalog) -> DataFrame:
    """Per cube, the number of categories of each classification, in order."""
    counted = catalog.classifications.join(
        catalog.categories.groupBy("agregado_id", "class_id").agg(F.count("*").alias("_n")),
        ["agregado_id", "class_id"],
        "left",
    )
    entry = F.struct("ord", F.coalesce("_n", F.lit(0)).cast("bigint").alias("n"))
    return counted.groupBy("agregado_id").agg(
        F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["n"]).alias("contagens")
    )


def cube_dimensions(catalog: Catalog) -> DataFrame:
    """Number of category combinations of each cube; null beyond 63 bits, see :func:`oversized_cubes`."""
    return _dimensions(catalog, "bigint")


def _dimensions(catalog: Catalog, kind: str) -> DataFrame:
    counts = F.coalesce("contagens", F.array().cast("array<bigint>"))
    return (
        catalog.cubes.select("agregado_id")
        .join(category_counts(catalog), "agregado_id", "left")
        .select(
            "agregado_id",
            F.size(counts).cast("bigint").alias("n_classificacoes"),
            product(counts, kind).alias("n_dimensoes"),
        )
    )


def oversized_cubes(catalog: Catalog) -> DataFrame:
    """Cubes whose flat rows a 63-bit number can't count, with their combinations (null beyond 38 digits).

    They are set aside: sizes that don't fit are null, and such a cube has no flat rows; other cubes go on.
    """
    variables = catalog.variables.groupBy("agregado_id").agg(F.count("*").alias("n_variaveis"))
    sized = _dimensions(catalog, BIG).join(variables, "agregado_id", "left").na.fill(0, ["n_variaveis"])
    rows = times("bigint", F.col("n_variaveis"), F.col("n_dimensoes"))
    return sized.where(rows.isNull() & (F.col("n_variaveis") > 0)).drop("n_variaveis")


def estimate_values(
    df: DataFrame,
    n_localities: str = "n_localidades",
    n_variables: str = "n_variaveis",
    counts: str = "contagens",
    n_periods: str = "n_periodos",
    kind: str = "bigint",
) -> DataFrame:
    """Add combinations, values per period and total values from plain counts; null beyond ``kind``."""
    sized = df.withColumn("n_dimensoes", product(F.col(counts), kind))
    combos = combinations(kind)
    period = times(kind, F.col(n_localities), F.col(n_variables), combos)
    sized = sized.withColumn("period_size", period)
    return sized.withColumn("total_size", times(kind, F.col("period_size"), F.col(n_periods)))


def combinations(kind: str) -> Column:
    """Combinations of a cube, at least one; null if there are too many."""
    return F.when(F.col("n_dimensoes").isNotNull(), F.greatest(F.col("n_dimensoes"), F.lit(1).cast(kind)))


def cube_counts(catalog: Catalog) -> DataFrame:
    """The counts of every cube: levels, localities, variables, classifications, periods."""
    by_level = F.struct("nivel", "n_localidades")
    places = (
        locality_counts(catalog.localities)
        .groupBy("agregado_id")
        .agg(
            F.sort_array(F.collect_list(by_level)).alias("stat_localidades"),
            F.count("*").alias("n_niveis_territoriais"),
            F.sum("n_localidades").alias("n_localidades"),
        )
    )
    variables = catalog.variables.groupBy("agregado_id").agg(F.count("*").alias("n_variaveis"))
    periods = catalog.periods.groupBy("agregado_id").agg(F.count("*").alias("n_periodos"))
    joined = catalog.cubes.select("agregado_id", "pesquisa_id")
    for part in (places, variables, category_counts(catalog), periods):
        joined = joined.join(part, "agregado_id", "left")
    numbers = ["n_niveis_territoriais", "n_localidades", "n_variaveis", "n_periodos"]
    return joined.na.fill(0, numbers).withColumns(
        {
            "contagens": F.coalesce("contagens", F.array().cast("array<bigint>")),
            "stat_localidades": F.coalesce(
                "stat_localidades",
                F.array().cast("array<struct<nivel: string, n_localidades: bigint>>"),
            ),
        }
    )


def cube_summary(catalog: Catalog, kind: str = "bigint") -> DataFrame:
    """Counts and value estimates of every cube."""
    sized = estimate_values(cube_counts(catalog), kind=kind)
    one = F.lit(1).cast(kind)
    combos = combinations(kind)
    return sized.select(
        "pesquisa_id",
        "agregado_id",
        F.map_from_entries("stat_localidades").alias("stat_localidades"),
        "n_niveis_territoriais",
        "n_localidades",
        "n_variaveis",
        F.size("contagens").cast("bigint").alias("n_classificacoes"),
        "n_dimensoes",
        "n_periodos",
        "period_size",
        times(kind, F.greatest(F.col("n_variaveis").cast(kind), one), combos).alias("localidade_size"),
        combos.alias("variavel_size"),
        "total_size",
    )
