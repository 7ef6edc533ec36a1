import pytest
from pyspark.sql import functions as F

from cubagem.functions import requests as R

FULL = "/t/31/n1/all/v/all/p/all/c15/all/d/v7%203,v8%201,v9%203,v250%206"
BASE = "https://api.example.org/values"


def parse(spark, urls, **options):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string")
    return R.parse_urls(df, **options).orderBy("i").collect()


def pairs(value):
    return {p.k: p.v for p in value}


def test_whole_url(spark):
    (row,) = parse(spark, [BASE + FULL], base_url=BASE)
    assert row.caminho == FULL
    assert (row.t, row.agregado) == ("/t/31", "31")
    assert (row.n, pairs(row.territorios)) == (["/n1/all"], {"1": ["all"]})
    assert (row.c, pairs(row.classificacoes)) == (["/c15/all"], {"15": ["all"]})
    assert (row.v, row.variaveis) == ("/v/all", ["all"])
    assert (row.p, row.periodos) == ("/p/all", ["all"])
    assert row.d == "/d/v7%203,v8%201,v9%203,v250%206"
    assert pairs(row.decimais) == {"7": "3", "8": "1", "9": "3", "250": "6"}
    assert (row.h, row.cabecalho, row.f, row.formato) == ("", True, "", "a")


def test_period_segments(spark):
    texts = ["201903,201904", "1994,1997", "202002-202011", "1991-1999", "200105,200206-200209",
             "last%207", "first", "all"]
    rows = parse(spark, [f"/t/1/p/{text}/v/all" for text in texts] + ["/t/1/v/all"])
    assert [r.periodos for r in rows[:-1]] == [text.split(",") for text in texts]
    assert [r.p for r in rows[:-1]] == [f"/p/{text}" for text in texts]
    assert (rows[-1].p, rows[-1].periodos) == ("", [])


def test_corrected_and_compatible_parsing(spark):
    url = "/t/9/n6/1,2/n10/3/v/allxp/c2/4,5/c81/allxt/h/n/f/u/d/2"
    (row,) = parse(spark, [url])
    assert pairs(row.territorios) == {"6": ["1", "2"], "10": ["3"]}
    assert pairs(row.classificacoes) == {"2": ["4", "5"], "81": ["allxt"]}
    assert (row.variaveis, pairs(row.decimais)) == (["allxp"], {"": "2"})
    assert (row.cabecalho, row.formato) == (False, "u")
    (row,) = parse(spark, [url], compat=True)
    assert row.n == ["/n6/1,2,2"] and pairs(row.territorios) == {"6": ["1", "2", "2"]}
    assert pairs(row.classificacoes) == {"2": ["4,5,5"], "81": ["all"]}
    assert (row.variaveis, row.decimais, row.d) == (["all"], [], "")


def test_repeated_segments_keep_place_and_last_value(spark):
    (row,) = parse(spark, ["/t/1/n6/1/n3/2/n6/7,8/v/all"])
    assert [(p.k, p.v) for p in row.territorios] == [("6", ["7", "8"]), ("3", ["2"])]


def selection(spark, **parts):
    values = {
        "agregado": "52", "territorios": [("3", ["all"])], "variaveis": ["63"],
        "periodos": ["201805", "201806"], "classificacoes": [("2", ["77"])],
        "cabecalho": True, "formato": "a", "decimais": [("", "m")], **parts,
    }
    kinds = {
        "agregado": "string", "territorios": R.LISTS, "variaveis": "array<string>",
        "periodos": "array<string>", "classificacoes": R.LISTS, "cabecalho": "boolean",
        "formato": "string", "decimais": R.PRECISION_LIST,
    }
    return spark.createDataFrame([tuple(values[k] for k in kinds)], ", ".join(f"{k} {t}" for k, t in kinds.items()))


def rendered(df, **options):
    return df.select(R.render_url(**options)).first()[0]


def test_render(spark):
    expected = "/t/52/n3/all/v/63/p/201805,201806/c2/77/h/y/f/a/d/m"
    assert rendered(selection(spark), base_url=BASE) == BASE + expected
    empty = selection(spark, territorios=[("1", ["5"]), ("6", [])], variaveis=[], periodos=None,
                      classificacoes=[("1", []), ("32", ["7", "8"])], cabecalho=False, decimais=[])
    assert rendered(empty) == "/t/52/n1/5/n6/all/v/all/p/all/c1/all/c32/7,8/h/n/f/a/d/m"
    several = selection(spark, decimais=[("9", "2"), ("8", "m")], classificacoes=[])
    assert rendered(several).endswith("/h/y/f/a/d/v9%202,v8%20m")
    single = selection(spark, decimais=[("9", "2")])
    assert rendered(single).endswith("/d/v9%202")
    assert rendered(single, compat=True).endswith("/d/m")


def test_assign_and_one_period(spark):
    whole = F.struct(*R.FIELDS)
    df = selection(spark)
    url = df.select(R.render_url(R.assign(whole, "formato", F.lit("u")))).first()[0]
    assert "/f/u/" in url and "/p/201805,201806/" in url
    assert "/p/202305/" in df.select(R.render_period_url(whole, F.lit(202305))).first()[0]
    with pytest.raises(ValueError):
        R.assign(whole, "cor", F.lit("azul"))


def test_domains(spark):
    assert selection(spark).select(R.invalid_domains()).first()[0] == []
    bad = selection(spark, formato="x", decimais=[("", "21")])
    assert bad.select(R.invalid_domains()).first()[0] == ["formato", "decimais"]


def test_normalising_equals_parsing_and_rendering(spark):
    urls = [
        BASE + FULL, BASE + FULL, "/t/1", "/t/1/v/all/p/all/h/y/f/a/d/m", "/t/2/n6/1,2/n6/3/c1/4/c1/all/d/v3%201,v3%202",
        "/v/all", "http://example.org/pt/2", "/t/5/f/u/n3/all/h/n/p/last%203/v/1,2/d/4",
    ]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r.url: r.n_pedidos for r in R.normalise_requests(df, base_url=BASE).collect()}
    slow = R.parse_urls(df, base_url=BASE).where("t <> ''")
    expected = {
        r.u: r.n for r in slow.groupBy(R.render_url(base_url=BASE).alias("u")).agg(F.count("*").alias("n")).collect()
    }
    assert got == expected
    assert got[BASE + "/t/1/v/all/p/all/h/y/f/a/d/m"] == 2
    assert BASE + "/t/2/n6/3/v/all/p/all/c1/all/h/y/f/a/d/v3%202" in got
