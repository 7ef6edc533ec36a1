"""Documents of the statistics service, as landed in a folder.

    agregados/indice_pesquisas.json            survey index
    agregados/{id}/metadados.json              cube metadata
    agregados/{id}/periodos.json               periods
    agregados/{id}/localidades_{nivel}.json    localities of one level
    acervos/{kind}.json                        collection listings
    valores/{id}-{nivel}-{chunk_seq}.json      values of one chunk

Each document is read whole, parsed with a fixed schema and exploded with positions. Many small
documents are better landed as rows of a table (caminho, body), with the same paths: the ``..._of``
functions take :func:`landed_documents` of such a table.
Documents that do not parse have no rows; :func:`unreadable_documents` lists them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubagem.catalog import Catalog
from cubagem.functions.json_text import is_list
from cubagem.operators.spread import dense_ordinal
from cubagem.schemas import COLLECTION_KINDS, RAW_LOCALITIES, RAW_METADATA, RAW_PERIODS, SURVEY_INDEX

METADATA = "agregados/*/metadados.json"
PERIODS = "agregados/*/periodos.json"
LOCALITIES = "agregados/*/localidades_*.json"
INDEX = "agregados/indice_pesquisas.json"
COLLECTIONS = "acervos/*.json"
VALUES = "valores/*.json"


def landed_documents(table: DataFrame, pattern: str) -> DataFrame:
    """Documents of a table (caminho, body) whose path fits, and, where it has one, their cube."""
    fits = "/" + pattern.replace(".", r"\.").replace("*", "[^/]*") + "$"
    cube = F.regexp_extract("caminho", r"/agregados/(\d+)/", 1)
    return table.where(F.col("caminho").rlike(fits)).select(
        "caminho", F.nullif(cube, F.lit("")).cast("bigint").alias("agregado_id"), "body"
    )


def read_documents(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Whole documents with their path and, where the path has one, their cube."""
    files = spark.read.text(f"{root}/{pattern}", wholetext=True)
    table = files.select(F.col("_metadata.file_path").alias("caminho"), F.col("value").alias("body"))
    return landed_documents(table, pattern)


def unreadable_of(metadata: DataFrame, periods: DataFrame, localities: DataFrame) -> DataFrame:
    """Documents that do not have their schema."""
    lists = [(periods, RAW_PERIODS), (localities, RAW_LOCALITIES)]
    found = metadata.where(F.from_json("body", RAW_METADATA)["id"].isNull()).drop("body")
    for docs, schema in lists:
        bad = F.from_json("body", schema).isNull() | ~is_list(F.col("body"))
        found = found.unionByName(docs.where(bad).drop("body"))
    return found


def unreadable_documents(spark: SparkSession, root: str) -> DataFrame:
    """Metadata, period and locality documents that do not have their schema."""
    return unreadable_of(*(read_documents(spark, root, p) for p in (METADATA, PERIODS, LOCALITIES)))


def survey_index_of(docs: DataFrame) -> DataFrame:
    listed = F.from_json("body", f"array<struct<{SURVEY_INDEX}>>")
    return docs.where(is_list(F.col("body"))).select(F.explode(listed).alias("_s")).select("_s.*")


def read_survey_index(spark: SparkSession, root: str) -> DataFrame:
    """Surveys with their cubes nested."""
    return survey_index_of(read_documents(spark, root, INDEX))


def metadata_of(docs: DataFrame) -> DataFrame:
    """Cube metadata as typed nested records, with the service's keys in snake case."""
    raw = docs.select(F.from_json("body", RAW_METADATA).alias("_m")).select("_m.*")
    return raw.where("id IS NOT NULL").select(
        "id",
        "nome",
        F.col("URL").alias("url"),
        F.struct(F.lit("").alias("id"), F.col("pesquisa").alias("nome")).alias("pesquisa"),
        "assunto",
        "periodicidade",
        F.struct(
            F.col("nivelTerritorial.Administrativo").alias("administrativo"),
            F.col("nivelTerritorial.Especial").alias("especial"),
            F.col("nivelTerritorial.IBGE").alias("ibge"),
        ).alias("nivel_territorial"),
        "variaveis",
        "classificacoes",
    )


def read_metadata(spark: SparkSession, root: str) -> DataFrame:
    return metadata_of(read_documents(spark, root, METADATA))


def periods_of(docs: DataFrame) -> DataFrame:
    return docs.where(is_list(F.col("body"))).select(
        "agregado_id", F.posexplode(F.from_json("body", RAW_PERIODS)).alias("ord", "_p")
    ).select(
        "agregado_id", F.col("_p.id").alias("per_id"), "_p.literals", "_p.modificacao", "ord"
    )


def read_periods(spark: SparkSession, root: str) -> DataFrame:
    return periods_of(read_documents(spark, root, PERIODS))


def localities_of(docs: DataFrame) -> DataFrame:
    """Localities, each once per cube and level, numbered in document order.

    A level may come in several documents, ``localidades_{nivel}_{parte}.json``, parts counted from 0.
    """
    part = F.coalesce(F.nullif(F.regexp_extract("caminho", r"_(\d{1,9})\.json$", 1), F.lit("")), F.lit("0"))
    exploded = docs.where(is_list(F.col("body"))).select(
        "agregado_id",
        (part.cast("bigint") * (1 << 32)).alias("_parte"),
        F.posexplode(F.from_json("body", RAW_LOCALITIES)).alias("_i", "_l"),
    )
    place = F.struct((F.col("_parte") + F.col("_i")).alias("_pos"), "_l.nome", F.col("_l.nivel.nome").alias("nivel_nome"))
    key = ["agregado_id", "nivel", "loc_id"]
    # Dealt whole and before they are grouped: both uses of the ordinal share the shuffle, and texts are parsed and sorted once.
    listed = exploded.select("agregado_id", F.col("_l.nivel.id").alias("nivel"), F.col("_l.id").alias("loc_id"), place.alias("_lugar"))
    distinct = listed.repartition(*key).groupBy(*key).agg(F.min("_lugar").alias("_lugar")).withColumn("_pos", F.col("_lugar._pos"))
    return dense_ordinal(distinct, ["agregado_id", "nivel"], "_pos").select(
        "agregado_id", "nivel", "_lugar.nivel_nome", "loc_id", "_lugar.nome", "ord"
    )


def read_localities(spark: SparkSession, root: str) -> DataFrame:
    return localities_of(read_documents(spark, root, LOCALITIES))


def read_collections(spark: SparkSession, root: str) -> DataFrame:
    """Collection listings as they come: one variant value per item, of any shape."""
    kind = F.regexp_extract("caminho", r"/acervos/([A-Z])\.json$", 1)
    listing = F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")
    return (
        read_documents(spark, root, COLLECTIONS)
        .select(kind.alias("acervo"), F.posexplode(listing).alias("ord", "item"))
        .where(F.col("acervo").isin(COLLECTION_KINDS))
    )


def read_collection_lines(spark: SparkSession, path: str) -> DataFrame:
    """Large listings, landed with one item per line in a folder per kind."""
    lines = spark.read.schema("value string, acervo string").text(path)
    return lines.select("acervo", F.try_parse_json("value").alias("item"))


def read_payloads(spark: SparkSession, root: str) -> DataFrame:
    """Landed value payloads, one file per chunk; the file is named after the chunk."""
    return payloads_of(read_documents(spark, root, VALUES))


def payloads_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.regexp_extract("caminho", r"/([^/]+)\.json$", 1).alias("chunk_id"), "body")


def collection_shapes(items: DataFrame) -> DataFrame:
    """(acervo, forma): one schema per kind that holds all its items."""
    return items.groupBy("acervo").agg(F.expr("schema_of_variant_agg(item)").alias("forma"))


def collection_paths(items: DataFrame) -> DataFrame:
    """(acervo, caminho, tipo, valor): each value inside items of unknown shape, with its path and type.

    ``items`` has ``acervo`` and the variant ``item``. Members of lists have the path ``[]``. Empty objects and
    lists, and nulls, are values. Items are opened level by level, until no item has one more.
    """
    spark = items.sparkSession
    rows = items.select("acervo", F.lit("$").alias("caminho"), F.col("item").alias("_v"))
    found = None
    while found is None or rows.take(1):
        typed = rows.withColumn("tipo", F.expr("schema_of_variant(_v)"))
        nested = F.col("tipo").startswith("OBJECT<") | F.col("tipo").startswith("ARRAY<")
        empty = F.col("tipo").isin("OBJECT<>", "ARRAY<VOID>") & (F.expr("to_json(_v)").isin("{}", "[]"))
        ends = typed.where(~nested | empty).select("acervo", "caminho", "tipo", F.expr("variant_get(_v, '$', 'string')").alias("valor"))
        found = ends if found is None else found.union(ends)
        inner = typed.where(nested & ~empty)
        exploded = inner.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer()))
        step = F.when(F.col("key").isNull(), "[]").otherwise(F.concat(F.lit("."), F.col("key")))
        rows = exploded.select("acervo", F.concat("caminho", step).alias("caminho"), F.col("value").alias("_v"))
    return found


def catalog_of(table: DataFrame) -> Catalog:
    """The normalised catalog of the cubes whose documents are rows of a table (caminho, body)."""
    return catalog_from_metadata(
        metadata_of(landed_documents(table, METADATA)),
        periods_of(landed_documents(table, PERIODS)),
        localities_of(landed_documents(table, LOCALITIES)),
    )


def catalog_from_documents(spark: SparkSession, root: str) -> Catalog:
    """The normalised catalog of all landed cubes."""
    return catalog_from_metadata(
        read_metadata(spark, root), read_periods(spark, root), read_localities(spark, root)
    )


def catalog_from_metadata(metadata: DataFrame, periods: DataFrame, localities: DataFrame) -> Catalog:
    cube = F.col("id").alias("agregado_id")
    levels = F.concat(
        *[
            F.transform(
                F.coalesce(F.col(f"nivel_territorial.{group}"), F.array().cast("array<string>")),
                _level_of(group),
            )
            for group in ("administrativo", "especial", "ibge")
        ]
    )
    classes = metadata.select(cube, F.posexplode("classificacoes").alias("_co", "_c"))
    return Catalog(
        cubes=metadata.select(
            cube,
            "nome",
            "url",
            F.col("pesquisa.id").alias("pesquisa_id"),
            F.col("pesquisa.nome").alias("pesquisa"),
            "assunto",
            "periodicidade.*",
        ),
        levels=metadata.select(cube, F.posexplode(levels).alias("ord", "_n")).select(
            "agregado_id", "_n.grupo", "_n.nivel", "ord"
        ),
        localities=localities,
        variables=metadata.select(cube, F.posexplode("variaveis").alias("ord", "_v")).select(
            "agregado_id",
            F.col("_v.id").alias("var_id"),
            "_v.nome",
            "_v.unidade",
            "_v.sumarizacao",
            "ord",
        ),
        classifications=classes.select(
            "agregado_id",
            F.col("_c.id").alias("class_id"),
            "_c.nome",
            "_c.sumarizacao",
            F.col("_co").alias("ord"),
        ),
        categories=classes.select(
            "agregado_id",
            F.col("_c.id").alias("class_id"),
            F.posexplode("_c.categorias").alias("ord", "_k"),
        ).select(
            "agregado_id",
            "class_id",
            F.col("_k.id").alias("cat_id"),
            "_k.nome",
            "_k.unidade",
            "_k.nivel",
            "ord",
        ),
        periods=periods,
    )


def _level_of(group: str):
    def entry(level: Column) -> Column:
        return F.struct(F.lit(group).alias("grupo"), level.alias("nivel"))

    return entry
