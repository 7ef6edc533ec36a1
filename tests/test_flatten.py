import itertools

import pytest
from pyspark.sql import functions as F

from cubagem.operators import flatten, listing
from cubagem.operators.spread import dense_ordinal, expand_range, prefix_sums

NESTED = (
    "agregado_id bigint, nome string, pesquisa string, assunto string, frequencia string, url string,"
    " variaveis array<struct<id: bigint, nome: string, unidade: string, sumarizacao: array<string>>>,"
    " classificacoes array<struct<id: bigint, nome: string,"
    " categorias: array<struct<id: bigint, nome: string, unidade: string, nivel: int>>>>"
)
# variables (id, unit); classifications: lists of categories (id, unit, depth)
CUBES = {
    1: ([(1, "Pessoas"), (2, "Vide categorias"), (3, None), (4, "")], []),
    2: ([(1, "Pessoas"), (2, "Vide categorias da tabela")], [[(10, None, 0), (11, "kg", 1)]]),
    3: (
        [(1, "Vide categorias"), (2, "")],
        [[(10, "t", 0), (11, "", 1)], [(20, None, 2), (21, "kg", 3), (0, "", 0)], [(30, None, 1)]],
    ),
    4: ([(1, "x")], [[(10, None, 0)], []]),
    5: ([], [[(10, None, 0)]]),
}


def nested(spark):
    rows = [
        (
            cube, f"Cubo {cube}", "P", "A", "mensal", f"/{cube}",
            [(i, f"V{i}", unit, []) for i, unit in variables],
            [
                (c, f"C{c}", [(k, f"K{k}", unit, depth) for k, unit, depth in categories])
                for c, categories in enumerate(classes, 1)
            ],
        )
        for cube, (variables, classes) in CUBES.items()
    ]
    return spark.createDataFrame(rows, NESTED)


def expected():
    """Every combination; the last category unit counts, else the variable's."""
    for cube, (variables, classes) in CUBES.items():
        for var_id, var_unit in variables:
            if var_unit and var_unit.startswith("Vide categorias"):
                var_unit = None
            for combo in itertools.product(*classes):
                units = [unit for _, unit, _ in combo if unit]
                unit = units[-1] if units else var_unit
                if not classes or unit is not None:
                    depth = combo[-1][2] if combo else 0
                    yield cube, var_id, tuple(k for k, _, _ in combo), unit, depth


def test_flatten_matches_enumeration(spark):
    for options in ({}, {"block": 2}, {"max_dims": 4}):
        flat = flatten.flatten_cubes(nested(spark), **options)
        rows = flat.orderBy("agregado_id", "ord").collect()
        got = [(r.agregado_id, r.D4C, tuple(c.cat_id for c in r.coordenadas), r.MN, r.nivel) for r in rows]
        assert got == list(expected())
    assert {r.agregado for r in rows if r.agregado_id == 2} == {"Cubo 2"}


def test_wide_columns(spark):
    flat = flatten.flatten_cubes(nested(spark))
    row = flatten.widen(flat, 3).where("agregado_id = 3 AND D4C = 2 AND C6C = 0").first()
    assert (row.D4N, row.D5C, row.D5N, row.C5C, row.D6N, row.C6N, row.D7C) == ("V2", 1, "C1", 10, "C2", "K0", 3)
    taken = flatten.widen(flat, 3, first_dim=4).where("agregado_id IN (1, 2)").collect()
    assert {(r.agregado_id, r.D4C, r.D4N) for r in taken if r.agregado_id == 2} == {(2, 1, "C1")}
    assert {r.D4C for r in taken if r.agregado_id == 1} == {1, 2, 3, 4}


def test_surveys(spark):
    index = spark.createDataFrame(
        [("P1", "Censo", [(1, "a"), (2, "b")]), ("P2", "Nada", []), ("P1", "Censo", [(3, "c")])],
        "id string, nome string, agregados array<struct<id: bigint, nome: string>>",
    )
    pairs = flatten.flatten_surveys(index).collect()
    assert sorted((r.pesquisa_id, r.agregado_id, r.agregado) for r in pairs) == [("P1", 1, "a"), ("P1", 2, "b"), ("P1", 3, "c")]
    counts = {r.pesquisa_id: r.n_agregados for r in listing.list_surveys(index).collect()}
    assert counts == {"P1": 3, "P2": 0}
    assert listing.list_survey_cubes(index, "P1").count() == 3
    try:
        listing.list_survey_cubes(index, "P9", check=True)
    except ValueError as error:
        assert "P9" in str(error)
    else:
        raise AssertionError("an unknown survey must be an error")


def test_selection_texts(spark):
    df = spark.createDataFrame([(1, " 63 , ,64,", "2=1, 2"), (2, None, " 81 = "), (3, "", "9")], "agregado_id bigint, l string, c string")
    lists = listing.parse_selection_lists(df, "l", "variavel").collect()
    assert [(r.agregado_id, r.dim, r.class_id, r.id) for r in lists] == [(1, "variavel", None, "63"), (1, "variavel", None, "64")]
    classes = listing.parse_class_selections(df, "c").orderBy("agregado_id", "id").collect()
    assert [(r.agregado_id, r.class_id, r.id) for r in classes] == [(1, "2", "1"), (1, "2", "2"), (2, "81", None), (3, "9", None)]


def test_ordinals_and_ranges(spark):
    keys = [(g, k) for g in ("a", "b") for k in range(0, 500, 7 if g == "a" else 3)]
    df = spark.createDataFrame(keys, "g string, k bigint")
    rows = dense_ordinal(df, ["g"], "k", width=32).orderBy("g", "k").collect()
    assert [r.ord for r in rows] == [*range(len([k for g, k in keys if g == "a"])), *range(len([k for g, k in keys if g == "b"]))]
    sizes = spark.createDataFrame([("a", 0), ("b", 1), ("c", 100), ("d", 64)], "g string, n bigint")
    out = expand_range(sizes, "n", "i", ["g"], block=8).groupBy("g").agg(F.count("*").alias("n"), F.sum("i").alias("s")).collect()
    assert {(r.g, r.n, r.s) for r in out} == {("b", 1, 0), ("c", 100, 4950), ("d", 64, 2016)}


def test_ordinals_of_keys_far_apart(spark):
    """A group of many keys, each in a slice of its own, both signs, and the sums before each."""
    df = spark.range(30_000).selectExpr("'a' AS g", "(id - 1000) * 33333333331 AS k", "id % 5 AS v", "id")
    found = dense_ordinal(df, ["g"], "k").where("ord <> id")
    assert found.count() == 0
    summed = prefix_sums(df, ["g"], "k", "v", "antes", width=1 << 36).orderBy("k").collect()
    before = 0
    for r in summed:
        assert r.antes == before
        before += r.v
    widest = prefix_sums(df, ["g"], "k", "v", "antes", width=1 << 36).selectExpr("k div (1 << 36) AS s").groupBy("s").count()
    assert widest.agg(F.max("count")).first()[0] < 10


def test_more_classifications_than_room_is_an_error(spark):
    with pytest.raises(Exception, match="max_dims is 2"):
        flatten.flatten_cubes(nested(spark), max_dims=2).collect()
    flat = flatten.flatten_cubes(nested(spark))
    with pytest.raises(Exception, match="max_dims is 1"):
        flatten.widen(flat, 1).collect()
