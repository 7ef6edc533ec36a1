"""The registered queries: every operator over whole input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubagem.catalog import Catalog
from cubagem.functions import periods as P
from cubagem.functions import requests as R
from cubagem.functions.literals import constant_rows
from cubagem.operators import assemble, flatten, ingest, listing, stats
from cubagem.oracle import PERIOD_QUERIES
from cubagem.plans import chunks, selections
from cubagem.session import discard, own_step, shared_dir, spread_scan
from cubagem.sources import documents, sinks, star
from cubagem.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MAX_DIMS = len(star.CLASSIFICATIONS)
PLAN_COLUMNS = ["agregado_id", "nivel_territorial", "chunk_seq", "n_valores", "url"]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def on_catalog(function: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    """Register a query that needs only the catalog."""
    QUERIES[function.__name__] = lambda spark, sf_dir: function(star.catalog_from_star(spark, sf_dir))
    return function


def on_written_catalog(function: Callable[[Catalog], DataFrame]) -> Callable[[Catalog], DataFrame]:
    """Register a query that needs several tables of the catalog."""
    QUERIES[function.__name__] = lambda spark, sf_dir: function(_written(spark, sf_dir))
    return function


def _written(spark: SparkSession, sf_dir: str) -> Catalog:
    path = shared_dir(spark, "catalogo")
    catalog = star.catalog_from_star(spark, sf_dir, written=True)
    catalog.save(path)
    discard(spark, catalog.members_path)
    return Catalog.load(spark, path)


# Surveys


@query
def flatten_surveys(spark, sf_dir):
    return flatten.flatten_surveys(star.survey_index(spark, sf_dir))


@query
def list_surveys(spark, sf_dir):
    return listing.list_surveys(star.survey_index(spark, sf_dir))


@query
def list_survey_cubes(spark, sf_dir):
    return listing.list_survey_cubes(star.survey_index(spark, sf_dir), "P7")


# Cube sizes


@on_catalog
def cube_locality_counts(catalog):
    return stats.locality_counts(catalog.localities)


@on_catalog
def cube_dimensions(catalog):
    return stats.cube_dimensions(catalog)


@on_written_catalog
def cube_estimate(catalog):
    return stats.estimate_values(stats.cube_counts(catalog)).select(
        "agregado_id", "n_dimensoes", "period_size", "total_size"
    )


@on_written_catalog
def cube_summary(catalog):
    return _summary(catalog)


def _summary(catalog: Catalog) -> DataFrame:
    pairs = F.transform(
        F.sort_array(F.map_entries("stat_localidades")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return stats.cube_summary(catalog).withColumn("stat_localidades", F.array_join(pairs, ","))


@on_catalog
def cube_info_variables(catalog):
    return listing.cube_info_variables(catalog)


@on_catalog
def cube_info_classifications(catalog):
    return listing.cube_info_classifications(catalog)


@on_catalog
def cube_periods(catalog):
    return listing.cube_periods(catalog)


# Periods


def _parsed_periods(catalog: Catalog) -> DataFrame:
    parsed = P.parse_periods(catalog.periods)
    return parsed.withColumn("modificacao", P.parse_date(F.col("modificacao"))).drop("literals", "ord")


def _period_query(frequency: str) -> Query:
    def run(spark, sf_dir):
        catalog = star.catalog_from_star(spark, sf_dir)
        return _parsed_periods(catalog).where(F.col("frequencia") == frequency)

    return run


for _name, _frequency in PERIOD_QUERIES.items():
    QUERIES[_name] = _period_query(_frequency)


@query
def parse_period_texts(spark, sf_dir):
    """Dates, months, quarters and rolling quarters of every order, written out and read back."""
    orders = star.read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    orders = spread_scan(orders, "o_orderkey")
    dated = orders.select(
        "o_orderkey",
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("_data"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("_mes"),
    )

    def text(frequency: str):
        return F.array(star.period_label(F.lit(frequency), F.col("_mes"))[1])

    def parsed(df, frequency: str, *fields: str):
        named = P.parse_periods(df.withColumn("literals", text(frequency)))
        kept = [F.col(field).cast("string").alias(f"{frequency}_{field}") for field in fields]
        return named.select(*df.columns, *kept)

    # Texts as soon as they are read: the JVM compiles no method as long as that of all columns together.
    read = dated.withColumn("_dia", P.parse_date(F.col("_data")).cast("string")).drop("_data")
    read = parsed(read, "mensal", "data_inicio", "data_fim", "mes")
    joined = F.concat_ws("|", "_dia", "mensal_data_inicio", "mensal_data_fim", "mensal_mes")
    read = read.select("o_orderkey", "_mes", joined.alias("mensal"))
    read = parsed(read, "trimestral", "data_fim")
    read = parsed(read, "trimestral móvel", "data_fim")
    return read.select(
        "o_orderkey",
        "mensal",
        F.col("trimestral_data_fim").alias("trimestre_fim"),
        F.col("trimestral móvel_data_fim").alias("movel_fim"),
    )


@on_catalog
def period_conformity(catalog):
    """Every period offered to cubes of several periodicities; those that fit stay."""
    offers = [" Mensal ", "TRIMESTRAL", "trimestral móvel", "Semestral", "anual", "decenal", "", "quinzenal"]
    offered = _parsed_periods(catalog).withColumn(
        "oferta", F.explode(F.array(*[F.lit(offer) for offer in offers]))
    )
    fitting = P.conforming_periods(offered, "oferta", "frequencia")
    return fitting.select("agregado_id", "per_id", "oferta", "frequencia")


# Flattening


@on_catalog
def flatten_cube(catalog):
    flat = flatten.flatten_cubes(catalog.nested_cubes(), MAX_DIMS)
    return flatten.widen(flat, MAX_DIMS).drop("ord")


@on_catalog
def flatten_cube_units(catalog):
    flat = flatten.flatten_cubes(catalog.nested_cubes(), MAX_DIMS)
    return flat.groupBy("agregado_id", "D4C", "MN", "nivel").agg(F.count("*").alias("n_linhas"))


# Plans


@on_written_catalog
def plan_full(catalog):
    return chunks.plan_chunks(catalog).select(*PLAN_COLUMNS)


def _plan_of_levels(catalog: Catalog, condition: str, limit: int) -> DataFrame:
    """Chunks of the levels whose plan takes a certain kind of split."""
    return chunks.plan_chunks(catalog, limit=limit, levels_where=condition).select(*PLAN_COLUMNS)


@on_written_catalog
def plan_period_split(catalog):
    return _plan_of_levels(catalog, "split_p AND NOT split_l", 100_000)


@on_written_catalog
def plan_locality_batches(catalog):
    return _plan_of_levels(catalog, "split_l", 100_000)


@on_written_catalog
def plan_variable_split(catalog):
    return _plan_of_levels(catalog, "split_v", 1_500)


@on_written_catalog
def plan_class_split(catalog):
    return _plan_of_levels(catalog, "n_c > 1", 200)


@on_written_catalog
def plan_summary(catalog):
    return chunks.plan_summary(chunks.plan_levels(catalog))


COVERAGE = [*chunks.LEVEL_KEY, "n_requests", "n_valores", "celulas", "exato", "cabe"]


@on_written_catalog
def plan_coverage(catalog):
    levels = chunks.plan_levels(catalog)
    return chunks.plan_coverage(levels, chunks.plan_chunks(catalog), catalog.localities).select(*COVERAGE)


@on_written_catalog
def plan_coverage_damaged(catalog):
    """The plan with gaps, doubles, chunks in the place of others, and requests that overlap or know no bounds."""
    plan = chunks.plan_chunks(catalog).select(
        *chunks.LEVEL_KEY, "chunk_seq", "periodos", "variaveis", "territorios", "classificacoes"
    )
    gap = "(nivel_territorial = 'N1' AND agregado_id % 3 = 0 AND chunk_seq = 0)"
    replaced = "(nivel_territorial = 'N6' AND agregado_id % 7 = 0 AND chunk_seq = 0)"
    replacing = "(nivel_territorial = 'N6' AND agregado_id % 7 = 0 AND chunk_seq = 1)"
    doubled = "(nivel_territorial = 'N3' AND agregado_id % 4 = 0 AND chunk_seq = 1)"
    overlapping = "(nivel_territorial = 'N3' AND agregado_id % 5 = 0 AND chunk_seq = 0)"
    boundless = "(nivel_territorial = 'N6' AND agregado_id % 11 = 0 AND chunk_seq = 0)"
    empty = F.array().cast("array<string>")
    own = {name: F.col(name) for name in plan.columns}
    everything = {"periodos": empty, "territorios": F.transform("territorios", lambda t: F.struct(t["k"].alias("k"), empty.alias("v")))}
    # (which chunks, what differs): the plan is made once, and a chunk gives as many rows as it fits
    versions = [
        (f"NOT {gap} AND NOT {replaced}", {}),
        (f"{replacing} OR {doubled}", {}),
        (overlapping, {"variaveis": F.array(F.lit("101"))}),
        (boundless, everything),
    ]
    rows = [
        F.when(F.expr(which), F.struct(*[value.alias(name) for name, value in (own | other).items()]))
        for which, other in versions
    ]
    damaged = plan.select(F.explode(F.array_compact(F.array(*rows))).alias("_c")).select("_c.*")
    return chunks.plan_coverage(chunks.plan_levels(catalog), damaged, catalog.localities).select(*COVERAGE)


@query
def plan_cell_location(spark, sf_dir):
    """Cells of the sales per chunk: each falls into one chunk of the plan, within its size."""
    catalog = _written(spark, sf_dir)
    located = star.located_cells(spark, sf_dir, catalog)
    per_chunk = located.groupBy("chunk_id").agg(F.sum(F.size("valores")).cast("bigint").alias("n_celulas"))
    path = shared_dir(spark, "celulas")
    with own_step(spark):
        per_chunk.write.option("compression", "zstd").parquet(path)
    per_chunk = spark.read.schema(per_chunk.schema).parquet(path)
    planned = chunks.plan_chunks(catalog).select("chunk_id", "n_valores")
    return per_chunk.join(planned, "chunk_id", "left")


def _restrictions(catalog: Catalog) -> DataFrame:
    """From every cube: levels N3, N6, two variables, periods from 1998 and some categories.

    Cubes whose survey ends in 9 ask for things they do not have.
    """
    fields = "dim string, class_id string, id string"
    usual = [("nivel", None, "N3"), ("nivel", None, "N6")]
    usual += [("variavel", None, "101"), ("variavel", None, "103")]
    wrong = [("variavel", None, "999"), ("classificacao", "77", "1")]
    asked = F.when(
        F.col("pesquisa_id").like("%9"), constant_rows(usual + wrong, fields)
    ).otherwise(constant_rows(usual, fields))
    everywhere = catalog.cubes.select("agregado_id", F.explode(asked).alias("_s")).select(
        "agregado_id", "_s.*"
    )
    ranges = catalog.cubes.select("agregado_id", F.array(F.lit("1998-1999"), F.lit("2000-9999")).alias("periodos"))
    resolved = selections.resolve_periods(ranges, catalog.periods)
    recent = resolved.select(
        "agregado_id",
        F.lit("periodo").alias("dim"),
        F.lit(None).cast("string").alias("class_id"),
        F.explode("resolvidos").alias("id"),
    )
    some = catalog.categories.where(
        "(class_id = 10 AND nome <> 'R') OR (class_id = 30 AND cat_id = 0)"
    ).select(
        "agregado_id",
        F.lit("classificacao").alias("dim"),
        F.col("class_id").cast("string").alias("class_id"),
        F.col("cat_id").cast("string").alias("id"),
    )
    return everywhere.unionByName(recent).unionByName(some)


@on_written_catalog
def plan_restricted(catalog):
    return chunks.plan_chunks(catalog, _restrictions(catalog), limit=2_000).select(*PLAN_COLUMNS)


@query
def resolve_periods(spark, sf_dir):
    """The periods that the request of every line item means, of the cube of its supplier."""
    log = star.request_log(spark, sf_dir).withColumn("agregado_id", F.col("agregado").cast("bigint") + 1)
    offered = star.catalog_from_star(spark, sf_dir).periods
    found = selections.resolve_periods(log.select(*star.REQUEST_KEY, "agregado_id", "periodos"), offered)
    return found.select(
        *star.REQUEST_KEY,
        F.size("resolvidos").cast("bigint").alias("n_periodos"),
        F.get("resolvidos", F.lit(0)).alias("primeiro"),
        F.try_element_at("resolvidos", F.lit(-1)).alias("ultimo"),
        F.array_join("sem_periodo", ",").alias("sem_periodo"),
    )


@on_written_catalog
def selection_errors(catalog):
    return selections.selection_errors(catalog, _restrictions(catalog))


@on_written_catalog
def selection_specs(catalog):
    """Selections of every cube written as text, as on a command line, and read back."""
    ids = F.sort_array(F.collect_list(F.col("cat_id").cast("string")))
    specs = catalog.categories.groupBy("agregado_id", "class_id").agg(
        F.concat(F.lit(" "), F.col("class_id").cast("string"), F.lit(" = "), F.array_join(ids, " ,, ")).alias("spec")
    )
    periods = catalog.periods.groupBy("agregado_id").agg(
        F.array_join(F.sort_array(F.collect_list("per_id")), ", ").alias("spec")
    )
    return listing.parse_class_selections(specs, "spec").unionByName(
        listing.parse_selection_lists(periods, "spec", "periodo")
    )


# Request URLs


@query
def render_url(spark, sf_dir):
    return star.request_log(spark, sf_dir).select(*star.REQUEST_KEY, R.render_url().alias("url"))


@query
def render_period_url(spark, sf_dir):
    """The request of every line item for one period more."""
    log = star.request_log(spark, sf_dir)
    selection = F.struct(*R.FIELDS)
    return log.select(*star.REQUEST_KEY, R.render_period_url(selection, F.lit(200101)).alias("url"))


def _url_query(name: str, parse) -> None:
    """Parse one part of the URLs of a request log and of web pages."""

    def run(spark, sf_dir):
        return star.url_log(spark, sf_dir).select(*star.REQUEST_KEY, *parse(F.col("url")))

    QUERIES[name] = run


def _text_pairs(pairs):
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(p["k"], F.lit("="), F.array_join(p["v"], ","))), ";"
    )


def _raw_and_list(parts):
    return [parts[0].alias("bruto"), F.array_join(parts[1], ",").alias("valor")]


def _raw_and_pairs(parts):
    return [F.array_join(parts[0], "").alias("bruto"), _text_pairs(parts[1]).alias("valor")]


def _raw_and_text(parts):
    return [parts[0].alias("bruto"), parts[1].cast("string").alias("valor")]


def _raw_and_precisions(parts):
    pairs = F.transform(parts[1], lambda p: F.concat(p["k"], F.lit("="), p["v"]))
    return [parts[0].alias("bruto"), F.array_join(pairs, ",").alias("valor")]


_url_query("parse_url_aggregate", lambda url: _raw_and_text(R.parse_aggregate(url)))
_url_query("parse_url_territories", lambda url: _raw_and_pairs(R.parse_territories(url)))
_url_query("parse_url_periods", lambda url: _raw_and_list(R.parse_periods_segment(url)))
_url_query("parse_url_variables", lambda url: _raw_and_list(R.parse_variables(url)))
_url_query("parse_url_classes", lambda url: _raw_and_pairs(R.parse_classifications(url)))
_url_query("parse_url_header", lambda url: _raw_and_text(R.parse_header(url)))
_url_query("parse_url_format", lambda url: _raw_and_text(R.parse_format(url)))
_url_query("parse_url_decimals", lambda url: _raw_and_precisions(R.parse_decimals(url)))


def _whole_urls(df: DataFrame, compat: bool) -> DataFrame:
    parsed = R.parse_urls(df, base_url=star.REQUEST_BASE, compat=compat)
    precisions = F.transform("decimais", lambda p: F.concat(p["k"], F.lit("="), p["v"]))
    raw = ["t", F.array_join("n", ""), F.array_join("c", ""), "v", "h", "f", "d", "p"]
    return parsed.select(
        *star.REQUEST_KEY,
        F.concat_ws("|", *raw).alias("partes"),
        "agregado",
        _text_pairs(F.col("territorios")).alias("territorios"),
        _text_pairs(F.col("classificacoes")).alias("classificacoes"),
        F.array_join("variaveis", ",").alias("variaveis"),
        F.array_join("periodos", ",").alias("periodos"),
        "cabecalho",
        "formato",
        F.array_join(precisions, ",").alias("decimais"),
    )


@query
def parse_urls_whole(spark, sf_dir):
    return _whole_urls(star.url_log(spark, sf_dir), compat=False)


@query
def parse_urls_compat(spark, sf_dir):
    """The same URLs in the older reading."""
    return _whole_urls(star.url_log(spark, sf_dir), compat=True)


@query
def request_domains(spark, sf_dir):
    """Formats and precisions of line items that the service does not know."""
    items = star.read_table(spark, sf_dir, "lineitem")
    precision = F.struct(F.lit("").alias("k"), F.col("l_quantity").cast("int").cast("string").alias("v"))
    asked = items.select(
        *star.REQUEST_KEY, F.lower("l_returnflag").alias("formato"), F.array(precision).alias("decimais")
    )
    return asked.select(*star.REQUEST_KEY, F.array_join(R.invalid_domains(), ",").alias("desconhecidos"))


@query
def normalise_requests(spark, sf_dir):
    return R.normalise_requests(star.url_log(spark, sf_dir), base_url=star.REQUEST_BASE)


# Values


def _landed(spark, sf_dir, catalog: Catalog | None = None, path: str | None = None) -> DataFrame:
    """All payloads, landed once; whatever reads them reads files."""
    return star.landed_payloads(spark, sf_dir, catalog or _written(spark, sf_dir), path)


def _records(spark, sf_dir, catalog: Catalog | None = None, path: str | None = None) -> DataFrame:
    return ingest.payload_records(ingest.one_per_chunk(_landed(spark, sf_dir, catalog, path)))


def _land(spark, sf_dir, source: str, catalog: Catalog | None = None) -> None:
    """All payloads in a landing folder, and nowhere else."""
    path = shared_dir(spark, "cargas")
    landing.land(_landed(spark, sf_dir, catalog, path), source)
    discard(spark, path)


def _write_values(spark, sf_dir, path: str, catalog: Catalog | None = None, header: bool = False) -> None:
    """All values written by cube and level."""
    kept = shared_dir(spark, "cargas")
    sinks.write_values(_records(spark, sf_dir, catalog, kept), path, header=header, compressed=True, source=kept)


def _planned(catalog: Catalog) -> DataFrame:
    return chunks.plan_levels(catalog).select(
        "agregado_id", "nivel_territorial", F.col("n_chunks").alias("planejados")
    )


def _value_columns() -> list:
    cats = F.concat_ws(",", *[F.col("registro")[f"D{i}C"] for i in range(4, 4 + MAX_DIMS)])
    return [
        F.col("registro")["D1C"].alias("loc_id"),
        F.col("registro")["D2C"].alias("per_id"),
        F.col("registro")["D3C"].alias("var_id"),
        cats.alias("categorias"),
        F.col("registro")["V"].alias("valor"),
    ]


@query
def validate_payloads(spark, sf_dir):
    """Payloads per cube and level, and what is wrong with the others."""
    status = ingest.payload_status(_landed(spark, sf_dir))
    return status.groupBy(*ingest.chunk_key()[:2], "erro").agg(F.count("*").alias("n_payloads"))


@query
def rejected_payloads(spark, sf_dir):
    """Each payload that is set aside, and why."""
    return ingest.rejected_payloads(_landed(spark, sf_dir)).select("chunk_id", "erro")


@query
def strip_headers(spark, sf_dir):
    return ingest.column_labels(_records(spark, sf_dir))


@query
def merge_values(spark, sf_dir):
    values = ingest.merged_values(_records(spark, sf_dir))
    return values.select("agregado_id", "nivel_territorial", *_value_columns())


def _by_level(values: DataFrame) -> DataFrame:
    valor = F.col("registro")["V"].cast("decimal(28,2)")
    return values.groupBy("agregado_id", "nivel_territorial").agg(
        F.count("*").alias("n_valores"), F.sum(valor).cast("decimal(38,2)").cast("string").alias("soma")
    )


@query
def values_by_level(spark, sf_dir):
    """Values written by cube and level, read back and summed."""
    path = shared_dir(spark, "valores")
    _write_values(spark, sf_dir, path)
    return _by_level(sinks.read_values(spark, path))


@query
def values_of_one_level(spark, sf_dir):
    """One level read through the index of the written values, with the place of each value."""
    path = shared_dir(spark, "valores")
    _write_values(spark, sf_dir, path)
    values = sinks.read_values(spark, path, "nivel_territorial = 'N3'")
    return values.select("agregado_id", "posicao", *_value_columns())


@query
def chunk_progress(spark, sf_dir):
    catalog = _written(spark, sf_dir)
    landed = _landed(spark, sf_dir, catalog)
    return ingest.chunk_progress(_planned(catalog), ingest.landed_chunks(landed))


@query
def stream_values(spark, sf_dir):
    """Payloads landed as files and streamed into a table of values."""
    source, sink = shared_dir(spark, "pouso"), shared_dir(spark, "tabela")
    _land(spark, sf_dir, source)
    stream = landing.landed_payloads(spark, source)
    landing.stream_values(stream, sink, shared_dir(spark, "progresso")).awaitTermination()
    return _by_level(ingest.value_records(landing.streamed_records(spark, sink)))


@query
def stream_repeated(spark, sf_dir):
    """Chunks that land again later, after a restart into a compacted sink: one payload of each counts."""
    source, sink, smaller = (shared_dir(spark, name) for name in ("pouso", "tabela", "compacto"))
    progress = shared_dir(spark, "progresso")
    first = _landed(spark, sf_dir)
    landing.land(first, source)
    landing.stream_values(landing.landed_payloads(spark, source), sink, progress).awaitTermination()
    landing.compact_values(spark, sink, smaller)
    # All of level N3 once more, as it was, and with other values, which count if their digest is less.
    again = first.where("split_part(chunk_id, '-', 2) = 'N3'")
    changed = again.withColumn("body", F.regexp_replace("body", '"V":"([0-9]+)', '"V":"1$1'))
    landing.land(again.unionByName(changed), source)
    landing.stream_values(landing.landed_payloads(spark, source), smaller, progress).awaitTermination()
    return _by_level(ingest.value_records(landing.streamed_records(spark, smaller)))


@query
def stream_progress(spark, sf_dir):
    """Landed and rejected chunks noted by a stream, next to the planned ones."""
    catalog = _written(spark, sf_dir)
    source, table = shared_dir(spark, "pouso"), shared_dir(spark, "tabela")
    _land(spark, sf_dir, source, catalog)
    stream = landing.landed_payloads(spark, source)
    landing.stream_landed(stream, table, shared_dir(spark, "progresso")).awaitTermination()
    schema = "agregado_id bigint, nivel_territorial string, chunk_seq bigint, aceito boolean"
    return ingest.chunk_progress(_planned(catalog), spark.read.schema(schema).parquet(table))


@query
def manifest(spark, sf_dir):
    """Manifests of the written values: sizes and digests of what lies in the files."""
    catalog = _written(spark, sf_dir)
    path, kept = shared_dir(spark, "valores"), shared_dir(spark, "manifestos")
    _write_values(spark, sf_dir, path, catalog, header=True)
    written = sinks.manifests(spark, path, chunks.first_requests(catalog), "estrela")
    sinks.write_manifests(written, kept)
    read = spark.read.schema(written.schema).json(kept)
    return read.select(
        "source_id",
        "dataset_id",
        "url",
        F.col("metadata")["n_requests"].alias("n_requests"),
        F.col("metadata")["n_linhas"].alias("n_linhas"),
        "sha256",
        "size_bytes",
        "path",
    )


# Whole cubes


def _assembled_summary(parts: DataFrame) -> DataFrame:
    return parts.groupBy("id").agg(
        F.max(F.size("periodos")).cast("bigint").alias("n_periodos"),
        F.max(F.size("variaveis")).cast("bigint").alias("n_variaveis"),
        F.max(F.size("classificacoes")).cast("bigint").alias("n_classificacoes"),
        F.sum(F.size("localidades")).alias("n_localidades"),
        F.max(F.try_element_at("periodos", F.lit(1))["data_inicio"]).alias("inicio"),
        F.max_by(F.try_element_at("localidades", F.lit(-1))["nome"], "parte").alias("ultima"),
        F.max(F.array_join(F.concat("nivel_territorial.administrativo", "nivel_territorial.especial", "nivel_territorial.ibge"), ",")).alias("niveis"),
    )


@on_written_catalog
def assemble_cube(catalog):
    return _assembled_summary(assemble.assemble_cubes(catalog, part_size=100))


@query
def assembled_localities(spark, sf_dir):
    catalog = star.catalog_from_star(spark, sf_dir)
    return assemble.assembled_localities(catalog).select(
        "agregado_id", "nivel_ord", "ord", "nivel", "loc_id", "nome"
    )


@query
def snapshot_roundtrip(spark, sf_dir):
    """Cubes saved as JSON and loaded; their periods parsed again."""
    path = shared_dir(spark, "cubos")
    sinks.save_snapshot(assemble.assemble_cubes(_written(spark, sf_dir)), path)
    periods = sinks.snapshot_periods(sinks.load_snapshot(spark, path))
    return periods.drop("literals", "ord")


@query
def snapshot_summary(spark, sf_dir):
    """Cubes saved in parts, loaded, and sized from what was loaded."""
    path, loaded = shared_dir(spark, "cubos"), shared_dir(spark, "catalogo")
    sinks.save_snapshot(assemble.assemble_cubes(_written(spark, sf_dir), part_size=100), path)
    # Seven tables come from the parts: they are parsed once.
    kept = shared_dir(spark, "partes")
    sinks.load_snapshot(spark, path).write.option("compression", "zstd").parquet(kept)
    sinks.catalog_from_snapshot(spark.read.parquet(kept)).save(loaded)
    return _summary(Catalog.load(spark, loaded))


@query
def snapshot_manifest(spark, sf_dir):
    """Place, size and digest of every saved part of every cube, from the written files."""
    path = shared_dir(spark, "cubos")
    sinks.save_snapshot(assemble.assemble_cubes(_written(spark, sf_dir), part_size=100), path)
    made = sinks.snapshot_manifests(spark, path, "estrela", "https://api.example.org/agregados")
    return made.select("source_id", "dataset_id", "parte", "url", "sha256", "size_bytes", "path", "arquivo", "inicio")


# Documents of the service


def _documents(spark, sf_dir) -> DataFrame:
    path = shared_dir(spark, "documentos")
    found = star.documents(_written(spark, sf_dir))
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


@query
def documents_cube_summary(spark, sf_dir):
    """The catalog written as documents and read back, sized."""
    path = shared_dir(spark, "catalogo")
    documents.catalog_of(_documents(spark, sf_dir)).save(path)
    return _summary(Catalog.load(spark, path)).drop("pesquisa_id")  # documents have its name only


@query
def documents_plan(spark, sf_dir):
    path = shared_dir(spark, "catalogo")
    documents.catalog_of(_documents(spark, sf_dir)).save(path)
    return chunks.plan_chunks(Catalog.load(spark, path)).select(*PLAN_COLUMNS)


@query
def documents_localities(spark, sf_dir):
    found = documents.localities_of(documents.landed_documents(_documents(spark, sf_dir), documents.LOCALITIES))
    return found.select("agregado_id", "nivel", "loc_id", "nome", "ord")


@query
def documents_unreadable(spark, sf_dir):
    patterns = (documents.METADATA, documents.PERIODS, documents.LOCALITIES)
    landed = _documents(spark, sf_dir)
    return documents.unreadable_of(*(documents.landed_documents(landed, p) for p in patterns))


@on_catalog
def metadata_urls(catalog):
    return assemble.metadata_urls(catalog, "https://api.example.org/agregados")


@query
def collection_listing(spark, sf_dir):
    """Collections of any shape, landed as text and listed by kind."""
    catalog = star.catalog_from_star(spark, sf_dir)
    path = shared_dir(spark, "acervos")
    star.collections(catalog).write.partitionBy("acervo").text(path)
    listed = documents.read_collection_lines(spark, path)
    return listed.groupBy("acervo", F.try_variant_get("item", "$.id", "string").alias("id")).agg(
        F.max(F.try_variant_get("item", "$.nome", "string")).alias("nome"), F.count("*").alias("n")
    )


@query
def collection_paths(spark, sf_dir):
    """What items of collections hold, found from the items alone: paths and types, with their least and largest values."""
    path = shared_dir(spark, "acervos")
    star.collections(star.catalog_from_star(spark, sf_dir)).write.partitionBy("acervo").text(path)
    found = documents.collection_paths(documents.read_collection_lines(spark, path))
    return found.groupBy("acervo", "caminho", "tipo").agg(
        F.count("*").alias("n"), F.min("valor").alias("menor"), F.max("valor").alias("maior")
    )


@query
def documents_surveys(spark, sf_dir):
    """The survey index written as documents, read back and flattened."""
    path = shared_dir(spark, "documentos")
    star.index_documents(spark, sf_dir).write.parquet(path)
    landed = documents.landed_documents(spark.read.parquet(path), documents.INDEX)
    return flatten.flatten_surveys(documents.survey_index_of(landed))


@query
def payload_files(spark, sf_dir):
    """Payloads landed as documents that are named after their chunks, read, merged and summed."""
    path = shared_dir(spark, "pouso")
    name = F.concat(F.lit("/valores/"), "chunk_id", F.lit(".json")).alias("caminho")
    kept = shared_dir(spark, "cargas")
    with own_step(spark):
        _landed(spark, sf_dir, path=kept).select(name, "body").write.option("compression", "zstd").parquet(path)
    discard(spark, kept)
    payloads = documents.payloads_of(documents.landed_documents(spark.read.parquet(path), documents.VALUES))
    return _by_level(ingest.value_records(ingest.payload_records(ingest.one_per_chunk(payloads))))
