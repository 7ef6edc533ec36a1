"""Whole cubes from their parts, and the requests that fetch those parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.catalog import Catalog, ordered_array
from cubagem.functions.literals import constant_array
from cubagem.functions.periods import parse_date, parse_periods
from cubagem.operators.spread import dense_ordinal
from cubagem.schemas import COLLECTION_KINDS, LOCALITY, PERIOD


def assembled_localities(catalog: Catalog) -> DataFrame:
    """Localities of the declared levels; levels in declared order, each locality once."""
    levels = catalog.levels.groupBy("agregado_id", "nivel").agg(F.min("ord").alias("nivel_ord"))
    return catalog.localities.join(levels, ["agregado_id", "nivel"])


def enriched_periods(catalog: Catalog) -> DataFrame:
    """Periods with parsed modification date, frequency, range and date parts."""
    return parse_periods(catalog.periods).withColumn("modificacao", parse_date(F.col("modificacao")))


def assemble_cubes(catalog: Catalog, part_size: int = 10_000) -> DataFrame:
    """Cubes as nested records, in parts of at most ``part_size`` localities.

    Part 0 of each cube has its metadata and periods. Localities are cut by level and
    position, so a cube of any size is assembled by many tasks; reading the parts of a
    cube in order gives its localities in order.
    """
    ids = ["agregado_id"]
    places = assembled_localities(catalog).withColumn("_corte", F.expr(f"ord div {part_size}"))
    locality = F.struct(
        F.col("loc_id").alias("id"),
        "nome",
        F.struct(F.col("nivel").alias("id"), F.col("nivel_nome").alias("nome")).alias("nivel"),
    )
    parts = ordered_array(
        places.select("agregado_id", "nivel_ord", "_corte", "ord", locality.alias("_l")),
        [*ids, "nivel_ord", "_corte"],
        "localidades",
        "_l",
    ).withColumn("localidades", F.transform("localidades", lambda e: e["_l"]))
    # Levels are few and cuts are dense within a level, so this key orders the parts.
    parts = parts.withColumn("_chave", F.col("nivel_ord") * F.lit(1 << 40) + F.col("_corte"))
    parts = dense_ordinal(parts, ids, "_chave", "parte", width=1 << 40)

    periods = ordered_array(
        enriched_periods(catalog),
        ids,
        "periodos",
        F.col("per_id").alias("id"),
        *["literals", "modificacao", "frequencia", "data_inicio", "data_fim"],
        *["ano", "mes", "trimestre", "semestre", "ano_fim"],
    )

    def group_of(name: str) -> Column:
        member = F.when(F.col("grupo") == name, F.struct("ord", "nivel"))
        names = F.transform(F.sort_array(F.collect_list(member)), lambda e: e["nivel"])
        return names.alias(name)

    groups = catalog.levels.groupBy(*ids).agg(
        group_of("administrativo"), group_of("especial"), group_of("ibge")
    )
    whole = (
        catalog.nested_cubes()
        .join(periods, ids, "left")
        .join(groups, ids, "left")
        .select(
            "agregado_id",
            F.lit(0).cast("bigint").alias("parte"),
            "nome",
            "url",
            F.struct(F.col("pesquisa_id").alias("id"), F.col("pesquisa").alias("nome")).alias("pesquisa"),
            "assunto",
            F.struct("frequencia", "inicio", "fim").alias("periodicidade"),
            F.struct(
                *[
                    F.coalesce(name, constant_array([], "string")).alias(name)
                    for name in ("administrativo", "especial", "ibge")
                ]
            ).alias("nivel_territorial"),
            "variaveis",
            "classificacoes",
            F.coalesce("periodos", F.array()).cast(f"array<{PERIOD}>").alias("periodos"),
        )
    )
    return (
        whole.join(parts.drop("nivel_ord", "_corte", "_chave"), [*ids, "parte"], "full")
        .withColumnRenamed("agregado_id", "id")
        .withColumn("localidades", F.coalesce("localidades", F.array()).cast(f"array<{LOCALITY}>"))
        .select(
            *["parte", "id", "nome", "url", "pesquisa", "assunto", "periodicidade"],
            *["nivel_territorial", "variaveis", "classificacoes", "periodos", "localidades"],
        )
    )


def metadata_urls(catalog: Catalog, base_url: str = "") -> DataFrame:
    """The metadata, period and locality requests of every cube and level."""
    base, cube = F.lit(base_url), F.col("agregado_id").cast("string")
    none = F.lit(None).cast("string")
    documents = F.array(
        *[
            F.struct(F.lit(kind).alias("tipo"), F.concat(base, F.lit("/"), cube, F.lit(f"/{kind}")).alias("url"))
            for kind in ("metadados", "periodos")
        ]
    )
    per_cube = catalog.cubes.select("agregado_id", none.alias("nivel"), F.explode(documents).alias("_d"))
    per_level = (
        catalog.levels.select("agregado_id", "nivel")
        .distinct()
        .select(
            "agregado_id",
            "nivel",
            F.lit("localidades").alias("tipo"),
            F.concat(base, F.lit("/"), cube, F.lit("/localidades/"), "nivel").alias("url"),
        )
    )
    return per_cube.select("agregado_id", "nivel", "_d.*").unionByName(per_level)


def index_url(base_url: str = "") -> str:
    """The request of the survey index."""
    return base_url


def collection_url(kind: Column, base_url: str = "") -> Column:
    """The request of a collection listing; null for a kind the service does not have."""
    known = kind.isin(COLLECTION_KINDS)
    return F.when(known, F.concat(F.lit(f"{base_url}?acervo="), F.url_encode(kind)))
