"""Restrictions of a plan to chosen levels, variables, periods and categories.

A selection table has the rows (agregado_id, dim, class_id, id), with ``dim`` one of
``nivel``, ``variavel``, ``periodo`` and ``classificacao``. A dimension of a cube that
has rows is restricted to their ids; without rows all of it is taken. A row with a
null id restricts the dimension to nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.catalog import Catalog, ordered_array

UNKNOWN = "inexistente"
EMPTY = "seleção vazia"

ERRORS = "array<struct<dim: string, class_id: string, id: string, motivo: string>>"
# (dimension, column with the ids there are, column with the chosen ids)
SIMPLE_DIMS = [
    ("nivel", "niveis", "_niveis"),
    ("variavel", "var_ids", "_variaveis"),
    ("periodo", "per_ids", "_periodos"),
]


def cube_pools(catalog: Catalog) -> DataFrame:
    """One row per cube: the ids of its levels, periods, variables and categories, in order.

    Each of these comes from one metadata document, which bounds the arrays.
    """

    def ids(df: DataFrame, column: str, name: str) -> DataFrame:
        text = F.col(column).cast("string").alias("v")
        listed = ordered_array(df, ["agregado_id"], name, text)
        return listed.withColumn(name, F.array_distinct(F.col(name)["v"]))

    categories = ordered_array(
        catalog.categories, ["agregado_id", "class_id"], "cats", F.col("cat_id").cast("string").alias("v")
    ).withColumn("cats", F.col("cats")["v"])
    classes = ordered_array(
        catalog.classifications.join(categories, ["agregado_id", "class_id"], "left"),
        ["agregado_id"],
        "classes",
        F.col("class_id").cast("string").alias("class_id"),
        F.coalesce("cats", F.array().cast("array<string>")).alias("cats"),
    )
    pools = ids(catalog.levels, "nivel", "niveis")
    for part in (
        ids(catalog.periods, "per_id", "per_ids"),
        ids(catalog.variables, "var_id", "var_ids"),
        classes,
    ):
        pools = pools.join(part, "agregado_id", "left")
    none = F.array().cast("array<string>")
    return pools.withColumns(
        {
            "per_ids": F.coalesce("per_ids", none),
            "var_ids": F.coalesce("var_ids", none),
            "classes": F.coalesce("classes", F.array().cast(classes.schema["classes"].dataType)),
        }
    )


ALL_PERIODS = r"^all"
SOME_PERIODS = r"^(first|last)(?:(?: |%20)(\d{1,9}))?$"
PERIOD_RANGE = r"^(\d+)-(\d+)$"


def resolve_periods(requests: DataFrame, periods: DataFrame, selectors: str = "periodos") -> DataFrame:
    """Add ``resolvidos``, the ids of the cube's periods that the selectors mean, in the cube's order, each once.

    A selector is ``all`` (with or without an ending), ``first``, ``last``, either with a number, a range ``a-b`` or an id. Both ends
    of a range belong to it, and stand for whatever begins with them: 2001-2003 has the months and quarters of these
    years. No selector at all means all periods, null is none. ``sem_periodo`` lists the selectors that mean no period of the cube.
    ``requests`` has ``agregado_id``; ``periods`` is that table of a catalog. A cube has one row of periods, bounded by
    its metadata, so a request meets its own cube's periods only, and no pairs are made.
    """
    offered = ordered_array(periods, ["agregado_id"], "_per", F.col("per_id").cast("string").alias("v"))
    offered = offered.withColumn("_per", F.array_distinct(F.col("_per")["v"]))
    joined = requests.join(offered, "agregado_id", "left").withColumn("_per", F.coalesce("_per", F.array().cast("array<string>")))

    def read(s: Column) -> Column:
        which, number = F.regexp_extract(s, SOME_PERIODS, 1), F.regexp_extract(s, SOME_PERIODS, 2)
        n = F.when(number == "", 1).otherwise(number.try_cast("int"))
        low, high = F.regexp_extract(s, PERIOD_RANGE, 1), F.regexp_extract(s, PERIOD_RANGE, 2)
        everything = s.rlike(ALL_PERIODS)
        single = ~everything & (which == "") & (low == "")
        return F.struct(
            s.alias("s"),
            # Positions from and below which the selector takes all, and the range it is otherwise.
            F.when(which == "last", F.size("_per") - n).when(everything | (which == "first"), 0).otherwise(F.size("_per")).alias("de"),
            F.when(which == "first", n).otherwise(F.size("_per")).alias("ate"),
            F.when(single, s).when(low != "", low).alias("a"),
            F.when(single, s).when(low != "", high).alias("b"),
            single.alias("so"),
        )

    def meant(s: Column, p: Column, i: Column) -> Column:
        placed = (i >= s["de"]) & (i < s["ate"])
        inside = (F.left(p, F.length(s["a"])) >= s["a"]) & (F.left(p, F.length(s["b"])) <= s["b"])
        return placed | F.coalesce(F.when(s["so"], p == s["a"]).otherwise(inside), F.lit(False))

    chosen = F.when(F.size(selectors) == 0, F.array(F.lit("all"))).otherwise(F.array_compact(selectors))
    parsed = joined.withColumn("_sel", F.transform(chosen, read))
    resolved = F.filter("_per", lambda p, i: F.exists("_sel", lambda s: meant(s, p, i)))
    missing = F.filter("_sel", lambda s: F.size(F.filter("_per", lambda p, i: meant(s, p, i))) == 0)
    none = F.array().cast("array<string>")
    return parsed.withColumns(
        {"resolvidos": F.coalesce(resolved, none), "sem_periodo": F.coalesce(F.transform(missing, lambda s: s["s"]), none)}
    ).drop("_per", "_sel")


def period_selections(requests: DataFrame, periods: DataFrame, selectors: str = "periodos") -> DataFrame:
    """Rows of a selection table for requests (agregado_id, selectors): the periods they mean, or what they ask for in vain."""
    resolved = resolve_periods(requests, periods, selectors)
    # A selector without a period stays as it is, and so is an error of its cube.
    ids = F.array_distinct(F.concat("resolvidos", "sem_periodo"))
    return resolved.select("agregado_id", F.explode(ids).alias("id")).distinct().select(
        "agregado_id", F.lit("periodo").alias("dim"), F.lit(None).cast("string").alias("class_id"), "id"
    )


def chosen_ids(selections: DataFrame) -> DataFrame:
    """One row per cube: the ids chosen in each dimension, null where nothing is said."""

    def of(dim: str, value: Column) -> Column:
        found = F.col("dim") == dim
        return F.when(F.max(found), F.sort_array(F.collect_set(F.when(found, value))))

    pair = F.struct("class_id", "id")
    return selections.groupBy("agregado_id").agg(
        *[of(dim, F.col("id")).alias(chosen) for dim, _, chosen in SIMPLE_DIMS],
        of("classificacao", pair).alias("_pares"),
    )


def _chosen_of_class(class_id: Column) -> Column:
    """Ids chosen in one classification; an empty array if only a null id is there."""
    own = F.filter("_pares", lambda p: p["class_id"] == class_id)
    return F.when(F.size(own) > 0, F.array_compact(F.transform(own, lambda p: p["id"])))


def restricted_pools(pools: DataFrame, selections: DataFrame | None) -> DataFrame:
    """Pools cut down to what is chosen, with what is restricted and with ``erros``."""
    if selections is None:
        no = F.lit(False)
        classes = F.transform(
            "classes", lambda c: F.struct(c["class_id"].alias("class_id"), c["cats"].alias("cats"), no.alias("restrita"))
        )
        return pools.withColumns(
            {"per_restrito": no, "var_restrito": no, "classes": classes, "erros": F.array().cast(ERRORS)}
        )
    joined = pools.join(chosen_ids(selections), "agregado_id", "left")
    restricted = joined.withColumn("erros", _errors())

    def cut(pool: str, chosen: str) -> Column:
        return F.when(F.col(chosen).isNull(), F.col(pool)).otherwise(F.array_intersect(pool, chosen))

    def cut_class(c: Column) -> Column:
        chosen = _chosen_of_class(c["class_id"])
        kept = F.when(chosen.isNull(), c["cats"]).otherwise(F.array_intersect(c["cats"], chosen))
        return F.struct(
            c["class_id"].alias("class_id"), kept.alias("cats"), chosen.isNotNull().alias("restrita")
        )

    return restricted.withColumns(
        {
            **{pool: cut(pool, chosen) for _, pool, chosen in SIMPLE_DIMS},
            "per_restrito": F.col("_periodos").isNotNull(),
            "var_restrito": F.col("_variaveis").isNotNull(),
            "classes": F.transform("classes", cut_class),
        }
    ).drop("_niveis", "_variaveis", "_periodos", "_pares")


def _errors() -> Column:
    """What is wrong with the selection of a cube."""
    null = F.lit(None).cast("string")

    def error(dim: str, class_id: Column, item: Column, reason: str) -> Column:
        return F.struct(
            F.lit(dim).alias("dim"),
            class_id.alias("class_id"),
            item.alias("id"),
            F.lit(reason).alias("motivo"),
        )

    def unknown_in(dim: str):
        return lambda item: error(dim, null, item, UNKNOWN)

    found = []
    for dim, pool, chosen in SIMPLE_DIMS:
        unknown = F.array_except(chosen, pool)
        found.append(F.transform(unknown, unknown_in(dim)))
        if dim != "nivel":
            empty = F.array(error(dim, null, null, EMPTY))
            found.append(F.when(F.size(chosen) == 0, empty))
    dim = "classificacao"
    asked = F.array_distinct(F.transform("_pares", lambda p: p["class_id"]))
    known = F.transform("classes", lambda c: c["class_id"])
    found.append(
        F.transform(F.array_except(asked, known), lambda c: error(dim, c, null, UNKNOWN))
    )
    in_class = F.transform(
        "classes",
        lambda c: F.transform(
            F.array_except(_chosen_of_class(c["class_id"]), c["cats"]),
            lambda i: error(dim, c["class_id"], i, UNKNOWN),
        ),
    )
    found.append(F.flatten(F.filter(in_class, lambda e: e.isNotNull())))
    empty_classes = F.filter("classes", lambda c: F.size(_chosen_of_class(c["class_id"])) == 0)
    found.append(F.transform(empty_classes, lambda c: error(dim, c["class_id"], null, EMPTY)))
    nothing = F.array().cast(ERRORS)
    return F.concat(*[F.coalesce(part.cast(ERRORS), nothing) for part in found])


def selection_errors(catalog: Catalog, selections: DataFrame) -> DataFrame:
    """Why selections cannot be planned: unknown ids, or nothing chosen.

    Restricting the levels to nothing is no error; such a cube simply has no chunks.
    """
    found = restricted_pools(cube_pools(catalog), selections).select(
        "agregado_id", F.explode("erros").alias("_e")
    )
    null = F.lit(None).cast("string")
    strangers = (
        selections.select("agregado_id")
        .distinct()
        .join(catalog.cubes.select("agregado_id"), "agregado_id", "left_anti")
        .select(
            "agregado_id",
            F.lit("agregado").alias("dim"),
            null.alias("class_id"),
            null.alias("id"),
            F.lit(UNKNOWN).alias("motivo"),
        )
    )
    return found.select("agregado_id", "_e.*").unionByName(strangers)


def require_valid(catalog: Catalog, selections: DataFrame) -> None:
    """Fail now if any selection has errors; says how many there are and shows the first few."""
    errors = selection_errors(catalog, selections)
    shown = errors.take(20)
    if shown:
        told = "; ".join(f"{r.agregado_id} {r.dim} {r.class_id or ''} {r.id or ''}: {r.motivo}" for r in shown)
        raise ValueError(f"{errors.count()}: {told}")
