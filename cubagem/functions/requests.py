"""Cube requests as URLs: render a selection, parse a URL.

A selection is a row with these columns; a null or empty list selects everything:

* ``agregado`` string
* ``territorios`` array<struct<k: string, v: array<string>>>, level number -> ids
* ``variaveis``, ``periodos`` array<string>
* ``classificacoes`` array<struct<k: string, v: array<string>>>, classification -> categories
* ``cabecalho`` boolean, ``formato`` string
* ``decimais`` array<struct<k: string, v: string>>, variable ("" for all) -> precision

Arrays of pairs keep the order of the segments, which a map would not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubagem.schemas import FORMATS, PRECISIONS

FIELDS = [
    "agregado",
    "territorios",
    "variaveis",
    "periodos",
    "classificacoes",
    "cabecalho",
    "formato",
    "decimais",
]
LISTS = "array<struct<k: string, v: array<string>>>"
PRECISION_LIST = "array<struct<k: string, v: string>>"

# The segments of a request URL.
AGGREGATE = r"/t/\d+"
TERRITORY = r"/n(\d+)/(all|\d+(?:,\d+)*)"
TERRITORY_ONE_DIGIT = r"/n(\d)/(all|\d+(?:,\d+)*)"
VARIABLES = r"/v/(?:allxp|all|\d+(?:,\d+)*)"
CLASSIFICATION = r"/c(\d+)/(allxt|all|\d+(?:,\d+)*)"
PERIOD_CODE = r"(?:\d{6}(?:-\d{6})?|\d{4}(?:-\d{4})?)"
PERIODS = rf"/p/(?:all|first(?:%20\d+)?|last(?:%20\d+)?|{PERIOD_CODE}(?:,{PERIOD_CODE})*)"
HEADER = r"/h/[yn]"
FORMAT = r"/f/[acnu]"
DECIMALS = r"/d/(?:v\d+%20(?:\d+|[ms])(?:,v\d+%20(?:\d+|[ms]))*|\d+|[ms])"
DECIMALS_STRICT = r"/d/(?:v\d+%20\d+(?:,v\d+%20\d+)*|[ms])"


def ids_text(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ",")).otherwise(F.lit("all"))


def segments(prefix: str, pairs: Column) -> Column:
    """``/n6/1,2`` for each pair, joined."""
    rendered = F.transform(
        pairs, lambda p: F.concat(F.lit(f"/{prefix}"), p["k"], F.lit("/"), ids_text(p["v"]))
    )
    return F.coalesce(F.array_join(rendered, ""), F.lit(""))


def _decimals(pairs: Column, compat: bool) -> Column:
    named = F.array_join(
        F.transform(pairs, lambda p: F.concat(F.lit("v"), p["k"], F.lit("%20"), p["v"])), ","
    )
    only = F.get(pairs, F.lit(0))
    single = F.when(only["k"] == "", only["v"]).otherwise(F.lit("m") if compat else named)
    return (
        F.when(F.size(pairs) >= 2, named).when(F.size(pairs) == 1, single).otherwise(F.lit("m"))
    )


def render_url(
    selection: Column | None = None,
    base_url: str = "",
    compat: bool = False,
    territories: Column | None = None,
    classifications: Column | None = None,
    variables: Column | None = None,
    periods: Column | None = None,
) -> Column:
    """The request URL of a selection, given as a struct or, by default, as columns.

    ``compat`` renders a single precision that names a variable as ``/d/m``. Segments
    that are already rendered may be passed as ``territories`` and ``classifications``, and
    lists of ids as ``variables`` and ``periods``.
    """

    def field(name: str) -> Column:
        return F.col(name) if selection is None else selection[name]

    return F.concat(
        F.lit(f"{base_url}/t/"),
        field("agregado"),
        segments("n", field("territorios")) if territories is None else territories,
        F.lit("/v/"),
        ids_text(field("variaveis")) if variables is None else variables,
        F.lit("/p/"),
        ids_text(field("periodos")) if periods is None else periods,
        segments("c", field("classificacoes")) if classifications is None else classifications,
        F.when(field("cabecalho"), F.lit("/h/y")).otherwise(F.lit("/h/n")),
        F.lit("/f/"),
        field("formato"),
        F.lit("/d/"),
        _decimals(field("decimais"), compat),
    )


def assign(selection: Column, name: str, value: Column) -> Column:
    """The selection with one part replaced."""
    if name not in FIELDS:
        raise ValueError(f"not a part of a selection: {name}")
    return selection.withField(name, value)


def render_period_url(selection: Column, period: Column, base_url: str = "") -> Column:
    """The URL of a selection restricted to one period."""
    return render_url(assign(selection, "periodos", F.array(period.cast("string"))), base_url)


def invalid_domains(selection: Column | None = None) -> Column:
    """Names of the parts whose value the service does not know: ``formato``, ``decimais``."""

    def field(name: str) -> Column:
        return F.col(name) if selection is None else selection[name]

    bad_precision = F.exists(
        field("decimais"), lambda p: ~F.coalesce(p["v"].isin(PRECISIONS), F.lit(False))
    )
    return F.array_compact(
        F.array(
            F.when(~F.coalesce(field("formato").isin(FORMATS), F.lit(False)), F.lit("formato")),
            F.when(bad_precision, F.lit("decimais")),
        )
    )


def _after(raw: Column, prefix_length: int) -> Column:
    return F.substring(raw, prefix_length + 1, 1 << 30)


def _list_or_empty(raw: Column, values: Column) -> Column:
    return F.when(raw != "", values).otherwise(F.array().cast("array<string>"))


def parse_aggregate(url: Column) -> tuple[Column, Column]:
    raw = F.regexp_extract(url, AGGREGATE, 0)
    return raw, _after(raw, 3)


def _last_per_key(pairs: Column, keys: Column) -> Column:
    """Keep each key where it first occurs, with its last value."""
    distinct = F.array_distinct(keys)
    merged = F.transform(
        distinct, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)
    )
    return F.when(F.size(distinct) == F.size(keys), pairs).otherwise(merged)


def _pairs(url: Column, pattern: str, split: bool, repeat_last: bool) -> tuple[Column, Column]:
    raw = F.regexp_extract_all(url, F.lit(pattern), F.lit(0))
    keys = F.regexp_extract_all(url, F.lit(pattern), F.lit(1))
    ids = F.regexp_extract_all(url, F.lit(pattern), F.lit(2))
    if repeat_last:
        raw, ids = (F.transform(texts, _repeat_last) for texts in (raw, ids))
    pairs = F.zip_with(
        keys,
        ids,
        lambda k, v: F.struct(k.alias("k"), (F.split(v, ",") if split else F.array(v)).alias("v")),
    )
    return raw, _last_per_key(pairs, keys)


def _repeat_last(text: Column) -> Column:
    return F.concat(text, F.regexp_extract(text, r",\d+$", 0))


def parse_territories(url: Column, compat: bool = False) -> tuple[Column, Column]:
    """``compat``: levels of one digit only, and the last id of a list comes twice."""
    return _pairs(url, TERRITORY_ONE_DIGIT if compat else TERRITORY, True, compat)


def parse_classifications(url: Column, compat: bool = False) -> tuple[Column, Column]:
    """``compat``: ids stay one text, with the last one twice, and ``allxt`` is ``all``."""
    pattern = CLASSIFICATION.replace("allxt|", "") if compat else CLASSIFICATION
    return _pairs(url, pattern, not compat, compat)


def parse_periods_segment(url: Column) -> tuple[Column, Column]:
    raw = F.regexp_extract(url, PERIODS, 0)
    return raw, _list_or_empty(raw, F.split(_after(raw, 3), ","))


def parse_variables(url: Column, compat: bool = False) -> tuple[Column, Column]:
    """``compat``: ``allxp`` is ``all``."""
    raw = F.regexp_extract(url, VARIABLES.replace("allxp|", "") if compat else VARIABLES, 0)
    return raw, _list_or_empty(raw, F.split(_after(raw, 3), ","))


def parse_header(url: Column) -> tuple[Column, Column]:
    raw = F.regexp_extract(url, HEADER, 0)
    return raw, raw != "/h/n"


def parse_format(url: Column) -> tuple[Column, Column]:
    raw = F.regexp_extract(url, FORMAT, 0)
    return raw, F.when(raw == "", F.lit("a")).otherwise(_after(raw, 3))


def parse_decimals(url: Column, compat: bool = False) -> tuple[Column, Column]:
    """``compat``: a number of digits for all variables is not read."""
    raw = F.regexp_extract(url, DECIMALS_STRICT if compat else DECIMALS, 0)
    body = _after(raw, 3)

    def pair(item: Column) -> Column:
        return F.struct(
            F.regexp_extract(item, r"^v(\d+)%20", 1).alias("k"),
            F.substring_index(item, "%20", -1).alias("v"),
        )

    items = F.split(body, ",")
    pairs = _last_per_key(
        F.transform(items, pair), F.transform(items, lambda item: pair(item)["k"])
    )
    return raw, F.when(raw != "", pairs).otherwise(F.array().cast(PRECISION_LIST))


def parse_urls(df: DataFrame, url: str = "url", base_url: str = "", compat: bool = False) -> DataFrame:
    """Add the raw segments ``t n c v h f d p`` and the selection columns of a URL."""
    text = F.col(url)
    if base_url:
        text = F.replace(text, F.lit(base_url), F.lit(""))
    parsed = {
        ("t", "agregado"): parse_aggregate(text),
        ("n", "territorios"): parse_territories(text, compat),
        ("c", "classificacoes"): parse_classifications(text, compat),
        ("v", "variaveis"): parse_variables(text, compat),
        ("h", "cabecalho"): parse_header(text),
        ("f", "formato"): parse_format(text),
        ("d", "decimais"): parse_decimals(text, compat),
        ("p", "periodos"): parse_periods_segment(text),
    }
    columns = {"caminho": text}
    for (raw_name, name), (raw, value) in parsed.items():
        columns[raw_name] = raw
        columns[name] = value
    return df.withColumns(columns)


def canonical_requests(df: DataFrame, url: str = "url", base_url: str = "") -> DataFrame:
    """Replace each URL by the one that parsing and rendering it again would give.

    A segment renders to the text it was parsed from, so segments are put together as
    they are, unless a level, a classification or a variable occurs twice. Texts
    without an aggregate are not requests and are dropped.
    """
    path = F.replace(F.col(url), F.lit(base_url), F.lit("")) if base_url else F.col(url)

    def every(pattern: str) -> Column:
        return F.array_join(F.regexp_extract_all("_url", F.lit(pattern), F.lit(0)), "")

    def first(pattern: str, missing: str) -> Column:
        found = F.regexp_extract("_url", pattern, 0)
        return F.when(found == "", F.lit(missing)).otherwise(found)

    cut = (
        df.withColumn("_url", path)
        .where(F.col("_url").rlike(AGGREGATE))
        .withColumns(
            {
                "_t": F.regexp_extract("_url", AGGREGATE, 0),
                "_n": every(TERRITORY),
                "_v": first(VARIABLES, "/v/all"),
                "_p": first(PERIODS, "/p/all"),
                "_c": every(CLASSIFICATION),
                "_h": first(HEADER, "/h/y"),
                "_f": first(FORMAT, "/f/a"),
                "_d": first(DECIMALS, "/d/m"),
            }
        )
        .drop("_url")
    )
    once = {
        "_n": (r"/n(\d+)/.*/n\1/", segments("n", parse_territories(F.col("_n"))[1])),
        "_c": (r"/c(\d+)/.*/c\1/", segments("c", parse_classifications(F.col("_c"))[1])),
        "_d": (
            r"v(\d+)%20.*v\1%20",
            F.concat(F.lit("/d/"), _decimals(parse_decimals(F.col("_d"))[1], False)),
        ),
    }
    merged = cut.withColumns(
        {
            name: F.when(F.col(name).rlike(twice), rendered).otherwise(F.col(name))
            for name, (twice, rendered) in once.items()
        }
    )
    parts = ["_t", "_n", "_v", "_p", "_c", "_h", "_f", "_d"]
    return merged.withColumn(url, F.concat(F.lit(base_url), *parts)).drop(*parts)


def normalise_requests(df: DataFrame, url: str = "url", base_url: str = "") -> DataFrame:
    """Distinct requests of a log of URLs, in canonical form, with how often each occurs.

    Equal requests are counted before the shuffle, so a request that dominates the log
    is no hot spot.
    """
    canonical = canonical_requests(df.select(url), url, base_url)
    return canonical.groupBy(F.col(url).alias("url")).agg(F.count("*").alias("n_pedidos"))
