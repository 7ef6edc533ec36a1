from pyspark.sql import functions as F

from cubagem.operators import flatten, stats
from tests.cubes import Cube, catalog


def test_summary(spark):
    cubes = [
        Cube(1, periods=2, localities={"N1": 2, "N2": 1}, variables=2, categories=(2, 3)),
        Cube(2, periods=84, localities={"N3": 27}, variables=1, categories=(2,)),
        Cube(3, periods=10, localities={"N3": 27}),
        Cube(4, periods=3, localities={"N1": 2}, variables=2, categories=(0, 3)),
    ]
    rows = {r.agregado_id: r for r in stats.cube_summary(catalog(spark, cubes)).collect()}
    first = rows[1]
    assert first.stat_localidades == {"N1": 2, "N2": 1}
    assert (first.n_niveis_territoriais, first.n_localidades, first.n_variaveis) == (2, 3, 2)
    assert (first.n_classificacoes, first.n_dimensoes, first.n_periodos) == (2, 6, 2)
    assert (first.period_size, first.total_size) == (36, 72)
    assert (first.localidade_size, first.variavel_size, first.pesquisa_id) == (12, 6, "P1")
    assert (rows[2].period_size, rows[2].total_size) == (54, 4536)
    assert (rows[3].n_dimensoes, rows[3].period_size, rows[3].total_size) == (1, 27, 270)
    # an empty classification counts as none in the sizes, but not in the product
    assert (rows[4].n_dimensoes, rows[4].period_size) == (0, 4)
    dims = {r.agregado_id: r.n_dimensoes for r in stats.cube_dimensions(catalog(spark, cubes)).collect()}
    assert dims == {1: 6, 2: 2, 3: 1, 4: 0}


def test_estimates_beyond_64_bits(spark):
    df = spark.createDataFrame(
        [(10**9, 10**4, [10**6, 10**3], 10**3)],
        "n_localidades bigint, n_variaveis bigint, contagens array<bigint>, n_periodos bigint",
    )
    big = stats.estimate_values(df, kind="decimal(38,0)").select(F.col("total_size").cast("string"))
    assert big.first()[0] == str(10**25)


def test_one_cube_too_large_does_not_fail_the_others(spark):
    cubes = catalog(spark, [
        Cube(1, variables=2, categories=(2, 3)),
        Cube(2, variables=3, periods=2, categories=(30,) * 16),
        Cube(3, variables=1, categories=(30,) * 27),
        Cube(4, variables=1, categories=(0, *(30,) * 27)),
        Cube(5, variables=4, categories=(2,) * 62),
    ])
    dims = {r.agregado_id: (r.n_classificacoes, r.n_dimensoes) for r in stats.cube_dimensions(cubes).collect()}
    assert dims == {1: (2, 6), 2: (16, None), 3: (27, None), 4: (28, 0), 5: (62, 2**62)}
    set_aside = {r.agregado_id: r.n_dimensoes for r in stats.oversized_cubes(cubes).collect()}
    assert set_aside == {2: 30**16, 3: None, 5: 2**62}
    rows = {r.agregado_id: r for r in stats.cube_summary(cubes).collect()}
    assert (rows[1].total_size, rows[4].total_size, rows[2].period_size, rows[5].variavel_size) == (12, 1, None, 2**62)
    assert {r.agregado_id: r.total_size for r in stats.cube_summary(cubes, stats.BIG).collect()}[2] == 30**16 * 6
    flat = flatten.flatten_cubes(cubes.nested_cubes()).groupBy("agregado_id").count().collect()
    assert {r.agregado_id: r["count"] for r in flat} == {1: 12}
