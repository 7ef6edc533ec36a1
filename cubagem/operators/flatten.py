"""One row per survey and cube, and one row per variable and category combination."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.operators.spread import expand_range
from cubagem.operators.stats import product, times

# Fixed value: a variable unit that starts so defers to the units of the categories.
UNIT_IN_CATEGORIES = "Vide categorias"

COORDINATES = (
    "array<struct<dim_id: bigint, dim_nome: string, cat_id: bigint, cat_nome: string,"
    " cat_unidade: string, cat_nivel: int>>"
)


def flatten_surveys(index: DataFrame) -> DataFrame:
    """Survey and cube pairs; a survey without cubes has no row."""
    return index.select(
        F.col("id").alias("pesquisa_id"),
        F.col("nome").alias("pesquisa"),
        F.explode("agregados").alias("_a"),
    ).select(
        "pesquisa_id",
        "pesquisa",
        F.col("_a.id").alias("agregado_id"),
        F.col("_a.nome").alias("agregado"),
    )


def flatten_cubes(
    nested: DataFrame, max_dims: int | None = None, block: int = 1 << 14
) -> DataFrame:
    """Every variable with every combination of categories, in long form.

    ``nested`` is :meth:`Catalog.nested_cubes`. The combinations of a cube are numbered
    and a number is read as digits, one per classification, with the last one fastest;
    so a cube with many combinations is spread over all tasks. ``coordenadas`` holds the
    chosen category of each classification. The unit ``MN`` is that of the last category
    that has one, else that of the variable; rows that end without a unit are dropped
    unless the cube has no classification.

    ``max_dims`` is the largest number of classifications of a cube. It fixes the
    expressions of a row, and is looked up with one aggregate if it is not given. A cube with
    more is an error. A cube of more rows than 63 bits count has none, see
    :func:`cubagem.operators.stats.oversized_cubes`.
    """
    if max_dims is None:
        largest = nested.agg(F.max(F.size("classificacoes"))).first()[0]
        max_dims = largest or 0
    base = ["agregado_id", "agregado", "pesquisa", "assunto", "frequencia", "url_agregado"]
    sizes = F.transform("classificacoes", lambda c: F.size(c["categorias"]).cast("bigint"))
    positions = range(max_dims)
    # Everything that is constant for a cube is prepared here, once per cube: what is
    # left for the rows is to pick by position.
    numbered = (
        nested.withColumnsRenamed({"nome": "agregado", "url": "url_agregado"})
        .withColumn("_tamanhos", sizes)
        .withColumn("_passos", strides(F.col("_tamanhos")))
        .withColumn("_combinacoes", product(F.col("_tamanhos")))
        .select(
            *base,
            _at_most(F.size("classificacoes"), max_dims).alias("_dims"),
            "_combinacoes",
            times("bigint", F.size("variaveis"), F.col("_combinacoes")).alias("_linhas"),
            F.transform("variaveis", _variable).alias("_variaveis"),
            *[_coordinates(position).alias(f"_k{position}") for position in positions],
            *[_at("_tamanhos", position).alias(f"_t{position}") for position in positions],
            *[_at("_passos", position).alias(f"_p{position}") for position in positions],
        )
    )
    rows = expand_range(numbered, "_linhas", "_n", ["agregado_id"], block)

    def picked(position: int) -> Column:
        digit = F.expr(f"cast(_n div _p{position} % _t{position} as int)")
        return F.get(f"_k{position}", digit).alias(f"_c{position}")

    located = rows.select(
        *base,
        F.col("_n").alias("ord"),
        "_dims",
        F.get("_variaveis", F.expr("cast(_n div _combinacoes as int)")).alias("_variavel"),
        *[picked(position) for position in positions],
    )
    chosen = [F.col(f"_c{position}") for position in positions]
    units = [F.nullif(c["cat_unidade"], F.lit("")) for c in reversed(chosen)]
    depths = [c["cat_nivel"] for c in reversed(chosen)]
    coordinates = F.array_compact(F.array(*chosen)) if chosen else F.array().cast(COORDINATES)
    return (
        located.select(
            *base,
            "ord",
            "_dims",
            F.col("_variavel.id").alias("D4C"),
            F.col("_variavel.nome").alias("D4N"),
            coordinates.alias("coordenadas"),
            F.coalesce(*units, F.col("_variavel.unidade")).alias("MN"),
            F.coalesce(*depths, F.lit(0)).alias("nivel"),
        )
        .where("_dims = 0 OR MN IS NOT NULL")
        .drop("_dims")
    )


def _at_most(count: Column, max_dims: int) -> Column:
    """A number of classifications, or an error where there are more than a row has room for."""
    return F.when(count <= max_dims, count).otherwise(
        F.raise_error(F.concat(F.lit(f"max_dims is {max_dims}, classifications: "), count.cast("string")))
    )


def _variable(v: Column) -> Column:
    deferred = F.coalesce(v["unidade"].startswith(UNIT_IN_CATEGORIES), F.lit(False))
    unit = F.when(~deferred, v["unidade"])
    return F.struct(v["id"].alias("id"), v["nome"].alias("nome"), unit.alias("unidade"))


def _at(array: str, position: int) -> Column:
    """Element of an array of counts, 1 beyond its end."""
    return F.coalesce(F.get(array, F.lit(position)), F.lit(1))


def _coordinates(position: int) -> Column:
    """The categories of one classification as coordinates; null if the cube has fewer."""
    classification = F.get("classificacoes", F.lit(position))
    return F.transform(
        classification["categorias"],
        lambda k: F.struct(
            classification["id"].alias("dim_id"),
            classification["nome"].alias("dim_nome"),
            k["id"].alias("cat_id"),
            k["nome"].alias("cat_nome"),
            k["unidade"].alias("cat_unidade"),
            k["nivel"].alias("cat_nivel"),
        ),
    )


def strides(sizes: Column) -> Column:
    """For each digit of a mixed-radix number, the product of the sizes after it."""
    return F.transform(sizes, lambda _, i: product(F.slice(sizes, i + 2, F.size(sizes))))


def widen(flat: DataFrame, max_dims: int, first_dim: int = 5) -> DataFrame:
    """Spread ``coordenadas`` over columns ``D5C, D5N, C5C, C5N, D6C, ...``.

    The variable is dimension 4, so the first classification is 5. With ``first_dim=4``
    the first classification takes the place of the variable where there is one. A row with
    more coordinates than ``max_dims`` is an error.
    """
    columns = {}
    whole = F.when(_at_most(F.size("coordenadas"), max_dims) >= 0, F.col("coordenadas"))
    flat = flat.withColumn("coordenadas", whole)
    for position in range(max_dims):
        entry = F.get("coordenadas", F.lit(position))
        number = first_dim + position
        for prefix, field in [("D{}C", "dim_id"), ("D{}N", "dim_nome")]:
            name = prefix.format(number)
            value = entry[field]
            columns[name] = F.coalesce(value, F.col(name)) if name in flat.columns else value
        columns[f"C{number}C"] = entry["cat_id"]
        columns[f"C{number}N"] = entry["cat_nome"]
    return flat.withColumns(columns).drop("coordenadas")
