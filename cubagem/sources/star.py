"""A statistics catalog and its values derived from a sales star schema.

Every supplier publishes one cube of its sales: measures by month (or another
period), by place of the customer and by up to five classifications. Surveys are
the nations of the suppliers. All tables are computed from whole input tables and
grow with them.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cubagem import session
from cubagem.catalog import Catalog, ordered_array
from cubagem.functions.literals import constant_array, constant_rows, sql_literal
from cubagem.functions.periods import MONTHS, rolling_label
from cubagem.functions.requests import LISTS, PRECISION_LIST, render_url
from cubagem.operators.spread import dense_ordinal, small_ordinal
from cubagem.plans.chunks import locate_cells, plan_levels
from cubagem.session import fine_width, own_step, shared_dir, spread_scan

PERIODICITIES = [
    "mensal",
    "trimestral",
    "trimestral móvel",
    "semestral",
    "anual",
    "decenal",
    "sem periodicidade",
]

# (id, name, column of the sales table)
CLASSIFICATIONS = [
    (10, "Devolução", "l_returnflag"),
    (20, "Situação", "l_linestatus"),
    (30, "Prioridade", "o_orderpriority"),
    (40, "Segmento", "c_mktsegment"),
    (50, "Linha", "l_linenumber"),
]

# Classifications of a cube by the region of its supplier.
REGION_CLASSIFICATIONS = {0: [], 1: [10], 2: [20, 30], 3: [10, 20, 30], 4: [10, 20, 30, 40, 50]}

# (id, name, unit, column of the sales table)
VARIABLES = [
    (101, "Quantidade", "Unidades", "l_quantity"),
    (102, "Valor das vendas", "Vide categorias da classificação", "l_extendedprice"),
    (103, "Desconto", "Percentual", "l_discount"),
    (104, "Imposto", "", "l_tax"),
]

LEVEL_NAMES = {"N1": "Região", "N3": "País", "N6": "Cliente", "N7": "Distrito"}
LEVEL_GROUPS = [("administrativo", ["N1", "N3"]), ("especial", ["N7"]), ("ibge", ["N6"])]


# Declared, so that opening a table reads no file.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz,"
    " o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(table_path(sf_dir, name))


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``columns`` of the line items with their orders, customers and customers' nations.

    Each table is joined only if a wanted column lies beyond it.
    """
    joins = [
        ("orders", "l_orderkey", "o_orderkey"),
        ("customer", "o_custkey", "c_custkey"),
        ("nation", "c_nationkey", "n_nationkey"),
    ]
    items = read_table(spark, sf_dir, "lineitem")
    needed = [c for c in items.columns if c in columns or c == "l_orderkey"]
    df = spread_scan(items.select(*needed), "l_orderkey")
    for table, key, other in joins:
        if set(columns) <= set(df.columns):
            break
        if table == "orders" and (parts := large_width(spark, sf_dir)):
            df = df.repartition(parts, key)
        df = df.join(read_table(spark, sf_dir, table), F.col(key) == F.col(other))
    return df.select(*columns)


def large_width(spark: SparkSession, sf_dir: str) -> int | None:
    """Partitions for rows like the sales, if there are more sales than the session's partitions suit, else null."""
    path = table_path(sf_dir, "lineitem")
    return fine_width(spark, path) if session.file_bytes(spark, path) > session.FINE_BYTES * fine_width(spark) else None


def cube_id(suppkey: str) -> Column:
    return (F.col(suppkey) + 1).cast("bigint")


def cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = read_table(spark, sf_dir, "supplier")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    periodicity = constant_array(PERIODICITIES, "string")
    return (
        supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            cube_id("s_suppkey").alias("agregado_id"),
            F.concat(F.lit("Vendas de "), "s_name").alias("nome"),
            F.concat(F.lit("/agregados/"), cube_id("s_suppkey").cast("string")).alias("url"),
            F.concat(F.lit("P"), "n_nationkey").alias("pesquisa_id"),
            F.col("n_name").alias("pesquisa"),
            F.col("r_name").alias("assunto"),
            F.get(periodicity, F.col("n_nationkey") % len(PERIODICITIES)).alias("frequencia"),
            F.lit(None).cast("string").alias("inicio"),
            F.lit(None).cast("string").alias("fim"),
            F.col("r_regionkey").alias("_regiao"),
        )
    )


def survey_index(spark: SparkSession, sf_dir: str, shard: int = 1 << 10) -> DataFrame:
    """Surveys with their cubes nested, at most ``shard`` cubes to a row.

    A survey with more cubes has several rows, so no row grows with the data.
    """
    entry = F.struct(F.col("agregado_id").alias("id"), "nome")
    return (
        cubes(spark, sf_dir)
        .groupBy("pesquisa_id", "pesquisa", F.expr(f"agregado_id div {shard}").alias("_parte"))
        .agg(F.sort_array(F.collect_list(entry)).alias("agregados"))
        .select(F.col("pesquisa_id").alias("id"), F.col("pesquisa").alias("nome"), "agregados")
    )


def index_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survey index as documents, rows of (caminho, body), each a list of surveys."""
    body = F.to_json(F.array(F.struct("id", "nome", "agregados")))
    return survey_index(spark, sf_dir).select(F.lit("/agregados/indice_pesquisas.json").alias("caminho"), body.alias("body"))


def levels(cubes_df: DataFrame) -> DataFrame:
    entries = [(group, level) for group, names in LEVEL_GROUPS for level in names]
    return per_cube(cubes_df, constant_rows(entries, "grupo string, nivel string"))


def variables(cubes_df: DataFrame) -> DataFrame:
    entries = [(var_id, name, unit) for var_id, name, unit, _ in VARIABLES]
    listed = per_cube(cubes_df, constant_rows(entries, "var_id bigint, nome string, unidade string"))
    return listed.withColumn("sumarizacao", F.array(F.lit("nivelTerritorial")))


def classifications(cubes_df: DataFrame) -> DataFrame:
    names = {class_id: name for class_id, name, _ in CLASSIFICATIONS}
    by_region = [
        constant_rows([(i, names[i]) for i in ids], "class_id bigint, nome string")
        for _, ids in sorted(REGION_CLASSIFICATIONS.items())
    ]
    listed = per_cube(cubes_df, F.get(F.array(*by_region), F.col("_regiao")))
    no_exceptions = constant_array([], "bigint")
    return listed.withColumn(
        "sumarizacao", F.struct(F.lit(True).alias("status"), no_exceptions.alias("excecao"))
    )


def per_cube(cubes_df: DataFrame, entries: Column) -> DataFrame:
    """The entries of an array of structs as rows of each cube, with their position."""
    exploded = cubes_df.select("agregado_id", F.posexplode(entries).alias("ord", "_e"))
    return exploded.select("agregado_id", "_e.*", "ord")


#: Tasks that the sales of one cube are dealt to.
SHARES = 4


def members(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    """What occurs in the sales of each cube: months, category names, places.

    One pass over the sales, for any of the kinds ``mes``, ``classe`` and ``local``: a sale gives
    one row per member, and equal rows are merged. A task would hold members of all cubes, so the sales of a
    cube first meet in ``SHARES`` tasks, by customer. Rows are (agregado_id, tipo, grupo, chave, ultimo).
    """
    date = F.col("o_orderdate").cast("date")
    month = F.trunc(date, "month")
    sources = {
        "mes": [("", month.cast("string"))],
        "classe": [(str(i), F.col(column).cast("string")) for i, _, column in CLASSIFICATIONS],
        "local": [
            (level, F.col(column).cast("string"))
            for level, column in [("N1", "n_regionkey"), ("N3", "c_nationkey"), ("N6", "o_custkey")]
        ],
    }
    needed = {
        "mes": ["o_orderdate"],
        "classe": [column for *_, column in CLASSIFICATIONS],
        "local": ["o_custkey", "c_nationkey", "n_regionkey"],
    }
    entries = [
        F.struct(
            F.lit(kind).alias("tipo"),
            F.lit(group).alias("grupo"),
            key.alias("chave"),
            (date if kind == "mes" else F.lit(None).cast("date")).alias("ultimo"),
        )
        for kind in kinds
        for group, key in sources[kind]
    ]
    columns = dict.fromkeys(["l_suppkey", "o_custkey", *[column for kind in kinds for column in needed[kind]]])
    facts = sales(spark, sf_dir, *columns).withColumns(
        {"agregado_id": cube_id("l_suppkey"), "_parte": F.pmod("o_custkey", F.lit(SHARES))}
    )
    width, member = fine_width(spark, table_path(sf_dir, "lineitem")), ["agregado_id", "tipo", "grupo", "chave"]
    shares = (
        facts.repartition(width, "agregado_id", "_parte")
        .select("agregado_id", "_parte", F.explode(F.array(*entries)).alias("_m"))
        .select("agregado_id", "_parte", "_m.*")
        .groupBy("_parte", *member)
        .agg(F.max("ultimo").alias("ultimo"))
    )
    return shares.repartition(width, *member).groupBy(*member).agg(F.max("ultimo").alias("ultimo"))


def category_code(text: Column) -> Column:
    """A number for a value, from its whole text: 48 bits of its digest."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("bigint")


def categories(found: DataFrame, classifications_df: DataFrame) -> DataFrame:
    """Values seen in a cube's sales, and a total in the priorities."""
    seen = (
        found.where("tipo = 'classe'")
        .select(
            "agregado_id",
            F.col("grupo").cast("bigint").alias("class_id"),
            F.col("chave").alias("nome"),
            category_code(F.col("chave")).alias("cat_id"),
            F.lit(1).alias("nivel"),
        )
        .join(classifications_df.select("agregado_id", "class_id"), ["agregado_id", "class_id"])
    )
    totals = classifications_df.where("class_id = 30").select(
        "agregado_id",
        "class_id",
        F.lit("Total").alias("nome"),
        F.lit(0).cast("bigint").alias("cat_id"),
        F.lit(0).alias("nivel"),
    )
    unit = (
        F.when((F.col("class_id") == 10) & (F.col("nome") == "A"), "Reais")
        .when((F.col("class_id") == 30) & (F.col("cat_id") == 0), "Mil Reais")
        .when((F.col("class_id") == 40) & (F.col("nome") < "C"), "")
        .when((F.col("class_id") == 50) & (F.col("nome") == "7"), "Peças")
    )
    listed = seen.unionByName(totals).select(
        "agregado_id",
        "class_id",
        "cat_id",
        "nome",
        unit.alias("unidade"),
        (F.col("nivel") + F.when(F.col("class_id") == 50, 1).otherwise(0)).alias("nivel"),
    )
    return small_ordinal(listed, ["agregado_id", "class_id"], "cat_id")


def period_label(frequency: Column, month: Column) -> tuple[Column, Column]:
    """Identifier and first literal of the period that a month falls into."""
    year, number = F.year(month), F.month(month)
    year_text = year.cast("string")

    def numbered(value: Column) -> Column:
        return F.concat(year_text, F.lpad(value.cast("string"), 2, "0"))

    quarter = F.quarter(month)
    half = F.when(number <= 6, 1).otherwise(2)
    decade = year - year % 10
    month_name = F.get(constant_array(MONTHS, "string"), number - 1)
    rolling_names = constant_array([rolling_label(m) for m in range(1, 13)], "string")
    rolling_name = F.get(rolling_names, number - 1)
    choices = [
        ("mensal", numbered(number), F.concat(month_name, F.lit(" "), year_text)),
        ("trimestral", numbered(quarter), F.concat(quarter, F.lit("º trimestre "), year_text)),
        ("trimestral móvel", numbered(number), F.concat(rolling_name, F.lit(" de "), year_text)),
        ("semestral", numbered(half), F.concat(half, F.lit("º semestre de "), year_text)),
        ("anual", year_text, year_text),
        ("decenal", decade.cast("string"), F.concat(decade, F.lit("/"), decade + 9)),
        ("sem periodicidade", year_text, F.concat(F.lit("edição "), year_text)),
    ]
    first, *others = choices
    identifier = F.when(frequency == first[0], first[1])
    literal = F.when(frequency == first[0], first[2])
    for name, period_id, text in others:
        identifier = identifier.when(frequency == name, period_id)
        literal = literal.when(frequency == name, text)
    return identifier, literal


def periods(found: DataFrame, cubes_df: DataFrame) -> DataFrame:
    """Periods with sales; the last order date of a period is its modification date."""
    months = found.where("tipo = 'mes'").select(
        "agregado_id", F.col("chave").cast("date").alias("_mes"), "ultimo"
    )
    identifier, literal = period_label(F.col("frequencia"), F.col("_mes"))
    grouped = (
        months.join(cubes_df.select("agregado_id", "frequencia"), "agregado_id")
        .groupBy("agregado_id", identifier.alias("per_id"), literal.alias("_literal"))
        .agg(F.max("ultimo").alias("ultimo"))
        .select(
            "agregado_id",
            "per_id",
            F.array("_literal", "per_id").alias("literals"),
            F.date_format("ultimo", "dd/MM/yyyy").alias("modificacao"),
        )
    )
    return small_ordinal(grouped, ["agregado_id"], "per_id")


def localities(found: DataFrame, parts: int | None = None) -> DataFrame:
    """Customers, their nations and regions that a cube has sales to; ``parts`` is that of ``dense_ordinal``."""
    places = found.where("tipo = 'local'").select(
        "agregado_id", F.col("grupo").alias("nivel"), F.col("chave").cast("bigint").alias("_lugar")
    )
    level_names = ", ".join(sql_literal(text) for pair in LEVEL_NAMES.items() for text in pair)
    names = F.expr(f"map({level_names})")
    return dense_ordinal(places, ["agregado_id", "nivel"], "_lugar", parts=parts).select(
        "agregado_id",
        "nivel",
        names[F.col("nivel")].alias("nivel_nome"),
        (F.col("_lugar") + 1).cast("string").alias("loc_id"),
        F.concat(names[F.col("nivel")], F.lit(" "), F.col("_lugar").cast("string")).alias("nome"),
        "ord",
    )


PAYLOAD_LEVELS = [("N1", "n_regionkey"), ("N3", "c_nationkey"), ("N6", "o_custkey")]


def cells(spark: SparkSession, sf_dir: str, catalog: Catalog) -> DataFrame:
    """Sales by cube, region or nation, period and categories: ``valores`` has one value per variable.

    Values are texts of exact decimals, as the service sends them.
    """
    cubes_df = cubes(spark, sf_dir).select("agregado_id", "frequencia", "_regiao")
    class_columns = {class_id: column for class_id, _, column in CLASSIFICATIONS}
    measures = [column for *_, column in VARIABLES]
    places = [column for _, column in PAYLOAD_LEVELS]
    wanted = ["l_suppkey", "o_orderdate", *class_columns.values(), *measures, *places]
    facts = sales(spark, sf_dir, *wanted).withColumn("agregado_id", cube_id("l_suppkey")).drop("l_suppkey")
    # One shuffle for the joins and the groups; AQE would merge partitions that are small only until the levels.
    width = fine_width(spark, table_path(sf_dir, "lineitem"))
    facts = facts.repartition(width, "agregado_id")
    codes = F.lit(None).cast("array<bigint>")
    for region, ids in REGION_CLASSIFICATIONS.items():
        own = F.array(*[category_code(F.col(class_columns[i]).cast("string")) for i in ids]).cast("array<bigint>")
        codes = F.when(F.col("_regiao") == region, own).otherwise(codes)
    level = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("nivel_territorial"),
                    (F.col(column) + 1).cast("string").alias("loc_id"),
                )
                for name, column in PAYLOAD_LEVELS
            ]
        )
    )
    dated = facts.join(cubes_df, "agregado_id").withColumn(
        "_mes", F.trunc(F.col("o_orderdate").cast("date"), "month")
    )
    # What a sale's levels share is made before they are.
    sold = dated.select(
        "agregado_id",
        *places,
        period_label(F.col("frequencia"), F.col("_mes"))[0].alias("per_id"),
        codes.alias("categorias"),
        *[F.col(column).cast("decimal(18,2)").alias(column) for column in measures],
    )
    grouped = (
        sold.select("agregado_id", level.alias("_l"), "per_id", "categorias", *measures)
        .groupBy("agregado_id", "_l", "per_id", "categorias")
        .agg(*[F.sum(column).cast("decimal(28,2)").alias(column) for column in measures])
    )
    values = F.array(
        *[
            F.struct(
                F.lit(var_id).cast("bigint").alias("var_id"), F.col(column).cast("string").alias("valor")
            )
            for var_id, _, _, column in VARIABLES
        ]
    )
    listed = grouped.select("agregado_id", "_l.*", "per_id", "categorias", values.alias("valores"))
    places_df = catalog.localities.select(
        "agregado_id", F.col("nivel").alias("nivel_territorial"), "loc_id", F.col("ord").alias("loc_ord")
    )
    return listed.join(places_df.repartition(width, "agregado_id"), ["agregado_id", "nivel_territorial", "loc_id"])


def located_cells(spark: SparkSession, sf_dir: str, catalog: Catalog) -> DataFrame:
    """Every cell with the chunk of the default plan it belongs to; ``valores`` has those that differ by variable only."""
    return locate_cells(plan_levels(catalog), cells(spark, sf_dir, catalog), folded="valores")


REFUSED = '{"status": 503, "message": "volte mais tarde"}'
CUT = "[] e mais"


def landed_payloads(spark: SparkSession, sf_dir: str, catalog: Catalog, path: str | None = None) -> DataFrame:
    """One payload per chunk that has cells; some landed again, refused, cut short or misnamed.

    The payloads are made once and written to ``path``, or to a folder of their own; the rows come from there. Cells are not
    shuffled: they are grouped, placed and put into their chunks in the task that has the sales of their cube.

    A chunk has at most as many cells as a request may return values, so a payload is
    bounded. Codes only: place, period, variable, then the categories. In every third cube the first
    chunk of N1 was refused; in every fourth the second chunk of a level landed twice. Each first
    chunk of N3 has a payload with text after its list as well, and each cube one that names
    no chunk.
    """
    dims = range(len(CLASSIFICATIONS))

    def record(cell: Column, value: Column) -> Column:
        return F.to_json(
            F.struct(
                cell["nivel_territorial"].alias("NC"),
                value["valor"].alias("V"),
                cell["loc_id"].alias("D1C"),
                cell["per_id"].alias("D2C"),
                value["var_id"].cast("string").alias("D3C"),
                *[F.get(cell["categorias"], F.lit(i)).cast("string").alias(f"D{i + 4}C") for i in dims],
            )
        )

    # Records are several times as long as what they say, so cells travel to their chunk and are rendered there.
    cell = F.struct("nivel_territorial", "loc_id", "per_id", "categorias", "valores")
    records = F.flatten(F.transform("_celulas", lambda c: F.transform(c["valores"], lambda v: record(c, v))))
    labels = F.to_json(
        F.struct(
            F.lit("Nível Territorial (Código)").alias("NC"),
            F.lit("Valor").alias("V"),
            F.lit("Local (Código)").alias("D1C"),
            F.lit("Período (Código)").alias("D2C"),
            F.lit("Variável (Código)").alias("D3C"),
            *[
                F.when(F.col("_dims") > i, F.lit(f"Classificação {i + 1} (Código)")).alias(f"D{i + 4}C")
                for i in dims
            ],
        )
    )
    body = F.concat(F.lit("["), labels, F.lit(","), F.array_join(F.sort_array(records), ","), F.lit("]"))
    stray = F.col("chunk_id").isNull()
    grouped = (
        located_cells(spark, sf_dir, catalog)
        .withColumn("_dims", F.size("categorias"))
        .groupBy("agregado_id", "chunk_id", "_dims")
        .agg(F.collect_list(cell).alias("_celulas"))
        .select("chunk_id", "_dims", F.when(~stray, body).alias("body"), F.when(stray, F.col("_celulas")).alias("_celulas"))
    )
    path = path or shared_dir(spark, "cargas")
    with own_step(spark):
        grouped.write.option("compression", "zstd").parquet(path)
    written = spark.read.schema(grouped.schema).parquet(path)
    # Cells without a chunk share a payload, whatever their cube.
    strays = written.where(stray).groupBy("chunk_id", "_dims").agg(F.flatten(F.collect_list("_celulas")).alias("_celulas"))
    good = written.where(~stray).select("chunk_id", "body").unionByName(strays.select("chunk_id", body.alias("body")))
    good = good.withColumn("cabecalho", F.lit(True))
    cube, number = F.split_part("chunk_id", F.lit("-"), F.lit(1)), F.split_part("chunk_id", F.lit("-"), F.lit(3))
    first_of = lambda level: F.col("chunk_id").endswith(f"-{level}-0")
    refused = first_of("N1") & (cube % 3 == 0)
    good = good.withColumn("body", F.when(refused, REFUSED).otherwise(F.col("body")))
    bodies = F.array(
        F.col("body"),
        F.when((number == "1") & (cube % 4 == 0), F.col("body")),
        F.when(first_of("N3"), F.lit(CUT)),
    )
    landed = good.select("chunk_id", "cabecalho", F.explode(F.array_compact(bodies)).alias("body"))
    misnamed = catalog.cubes.select(
        F.concat(F.lit("cubo "), F.col("agregado_id").cast("string")).alias("chunk_id"),
        F.lit(True).alias("cabecalho"),
        F.lit("[]").alias("body"),
    )
    return landed.unionByName(misnamed)


def documents(catalog: Catalog, places_per_document: int = 1000) -> DataFrame:
    """The catalog as the service's documents, rows of (caminho, body); one cube in ten has a broken one.

    A level's localities come in parts, so no document grows with the data.
    """
    root = F.concat(F.lit("/agregados/"), F.col("agregado_id").cast("string"), F.lit("/"))

    def rows(df: DataFrame, name: Column, body: Column) -> DataFrame:
        return df.select(F.concat(root, name, F.lit(".json")).alias("caminho"), F.to_json(body).alias("body"))

    grouped = ordered_array(
        catalog.levels.withColumn("_g", F.col("grupo")), ["agregado_id", "_g"], "_niveis", "nivel"
    ).groupBy("agregado_id").pivot("_g", ["administrativo", "especial", "ibge"]).agg(
        F.first(F.transform("_niveis", lambda n: n["nivel"]))
    )
    cubes_df = catalog.nested_cubes().join(grouped, "agregado_id", "left")
    metadata = rows(
        cubes_df,
        F.lit("metadados"),
        F.struct(
            F.col("agregado_id").alias("id"),
            "nome",
            F.col("url").alias("URL"),
            "pesquisa",
            "assunto",
            F.struct("frequencia", "inicio", "fim").alias("periodicidade"),
            F.struct(
                F.col("administrativo").alias("Administrativo"),
                F.col("especial").alias("Especial"),
                F.col("ibge").alias("IBGE"),
            ).alias("nivelTerritorial"),
            "variaveis",
            "classificacoes",
        ),
    )
    listed = ordered_array(
        catalog.periods, ["agregado_id"], "_p", F.col("per_id").alias("id"), "literals", "modificacao"
    )
    places = ordered_array(
        catalog.localities.withColumn("_parte", F.expr(f"ord div {places_per_document}")),
        ["agregado_id", "nivel", "_parte"],
        "_l",
        F.col("loc_id").alias("id"),
        "nome",
        F.struct(F.col("nivel").alias("id"), F.col("nivel_nome").alias("nome")).alias("nivel"),
    )
    name = F.concat(F.lit("localidades_"), "nivel", F.lit("_"), F.col("_parte").cast("string"))
    broken = catalog.cubes.where("agregado_id % 10 = 0").select(
        F.concat(root, F.lit("localidades_N9_0.json")).alias("caminho"), F.lit(REFUSED).alias("body")
    )
    found = metadata.unionByName(rows(listed, F.lit("periodos"), F.col("_p")))
    return found.unionByName(rows(places, name, F.col("_l"))).unionByName(broken)


def collections(catalog: Catalog) -> DataFrame:
    """Items of the collection listings as JSON texts; each kind has its own shape."""

    def items(df: DataFrame, kind: str, *fields: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("acervo"), F.to_json(F.struct(*fields)).alias("value"))

    parts = [
        items(catalog.cubes, "A", F.col("assunto").alias("id"), F.col("assunto").alias("nome")),
        items(catalog.classifications, "C", F.col("class_id").alias("id"), F.col("nome")),
        items(catalog.levels, "N", F.col("nivel").alias("id"), F.struct("grupo").alias("detalhe")),
        items(catalog.periods, "P", F.col("per_id").alias("id"), F.col("literals")),
        items(catalog.cubes, "E", F.col("frequencia").alias("id")),
        items(catalog.variables, "V", F.col("var_id").alias("id"), F.col("nome"), F.col("unidade")),
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


REQUEST_KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
REQUEST_BASE = "https://api.example.org/values"


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A selection per line item: its supplier's cube, and what the line says."""

    def text(column: str) -> Column:
        return F.col(column).cast("string")

    def pair(key: Column, value: Column) -> Column:
        return F.struct(key.alias("k"), value.alias("v"))

    everything = constant_array([], "string")
    columns = [*REQUEST_KEY, "l_suppkey", "l_returnflag", "l_linestatus", "l_shipdate"]
    items = spread_scan(read_table(spark, sf_dir, "lineitem").select(*columns), "l_orderkey")
    month = F.date_format("l_shipdate", "yyyyMM")
    return items.select(
        *REQUEST_KEY,
        F.col("l_suppkey").cast("string").alias("agregado"),
        F.when(
            F.col("l_returnflag") == "N",
            F.array(
                pair(F.lit("6"), F.array(text("l_partkey"), text("l_orderkey"))),
                pair(F.lit("10"), everything),
            ),
        )
        .otherwise(F.array(pair(F.lit("3"), F.array(text("l_linenumber")))))
        .alias("territorios"),
        F.when(F.col("l_linestatus") == "F", everything)
        .otherwise(F.array(text("l_linenumber"), F.lit("33")))
        .alias("variaveis"),
        F.when(F.col("l_linenumber") == 1, everything)
        .when(F.col("l_linenumber") == 2, F.array(F.lit("last%2012")))
        .otherwise(F.array(month, F.concat(month, F.lit("-"), month)))
        .alias("periodos"),
        F.when(F.col("l_returnflag") == "R", F.array().cast(LISTS))
        .otherwise(
            F.array(
                pair(F.lit("2"), F.array(text("l_linenumber"), text("l_partkey"))),
                pair(F.lit("81"), everything),
            )
        )
        .alias("classificacoes"),
        (F.col("l_linestatus") == "F").alias("cabecalho"),
        F.when(F.col("l_returnflag") == "A", "a")
        .when(F.col("l_returnflag") == "N", "n")
        .otherwise("u")
        .alias("formato"),
        F.when(F.col("l_linenumber") == 3, F.array(pair(F.lit(""), F.lit("2"))))
        .when(
            F.col("l_linenumber") == 4,
            F.array(pair(text("l_partkey"), F.lit("5")), pair(F.lit("33"), F.lit("0"))),
        )
        .when(F.col("l_linenumber") == 5, F.array(pair(F.lit("33"), F.lit("m"))))
        .when(F.col("l_linenumber") == 6, F.array(pair(F.lit(""), F.lit("s"))))
        .otherwise(F.array().cast(PRECISION_LIST))
        .alias("decimais"),
    )


def url_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rendered requests of all line items, and the URLs of web pages, which are none."""
    rendered = request_log(spark, sf_dir).select(
        *REQUEST_KEY, render_url(base_url=REQUEST_BASE).alias("url")
    )
    pages = read_table(spark, sf_dir, "pages").select(
        (-F.col("page_id") - 1).alias("l_orderkey"),
        F.lit(0).alias("l_linenumber"),
        F.lit(0).cast("bigint").alias("l_partkey"),
        "url",
    )
    return rendered.unionByName(pages)


class StarCatalog(Catalog):
    """A catalog whose tables are defined when they are first used.

    With ``written`` the members of all cubes are first written to the shared folder,
    in one pass over the sales. Jobs that use several of the tables, or one of them
    several times, then read them from there.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, written: bool = False) -> None:
        object.__setattr__(self, "source", (spark, sf_dir))
        object.__setattr__(self, "written", written)

    def _members(self, kind: str) -> DataFrame:
        if not self.written:
            return members(*self.source, kind)
        return self._written_members.where(F.col("tipo") == kind)

    @cached_property
    def members_path(self) -> str:
        """Where ``written`` members are; whoever has saved the catalog may discard them."""
        return shared_dir(self.source[0], "membros")

    @cached_property
    def _written_members(self) -> DataFrame:
        spark, _ = self.source
        path = self.members_path
        found = members(*self.source, "mes", "classe", "local")
        with own_step(spark):
            found.write.partitionBy("tipo").parquet(path)
        schema = "agregado_id bigint, grupo string, chave string, ultimo date, tipo string"
        return spark.read.schema(schema).parquet(path)

    @cached_property
    def _cubes(self) -> DataFrame:
        return cubes(*self.source)

    @cached_property
    def cubes(self) -> DataFrame:
        return self._cubes.drop("_regiao")

    @cached_property
    def levels(self) -> DataFrame:
        return levels(self._cubes)

    @cached_property
    def localities(self) -> DataFrame:
        return localities(self._members("local"), large_width(*self.source))

    @cached_property
    def variables(self) -> DataFrame:
        return variables(self._cubes)

    @cached_property
    def classifications(self) -> DataFrame:
        return classifications(self._cubes)

    @cached_property
    def categories(self) -> DataFrame:
        return categories(self._members("classe"), self.classifications)

    @cached_property
    def periods(self) -> DataFrame:
        return periods(self._members("mes"), self._cubes)


def catalog_from_star(spark: SparkSession, sf_dir: str, written: bool = False) -> Catalog:
    return StarCatalog(spark, sf_dir, written)
