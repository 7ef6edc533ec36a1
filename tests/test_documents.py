import datetime as dt
import hashlib
import json

from pyspark.sql import functions as F

from cubagem.operators import assemble, stats
from cubagem.plans.chunks import plan_chunks
from cubagem.sources import documents, sinks

METADATA = {
    "id": 1705, "nome": "População", "URL": "http://x/1705", "pesquisa": "Censo", "assunto": "Demografia",
    "periodicidade": {"frequencia": "mensal", "inicio": 202301, "fim": 202302},
    "nivelTerritorial": {"Administrativo": ["N1", "N6"], "Especial": ["N9"], "IBGE": ["N1"]},
    "variaveis": [{"id": 4099, "nome": "Taxa", "unidade": "%", "sumarizacao": ["a"]}],
    "classificacoes": [
        {"id": 2, "nome": "Sexo", "sumarizacao": {"status": True, "excecao": [1]},
         "categorias": [{"id": 0, "nome": "Total", "unidade": None, "nivel": 0},
                        {"id": 4, "nome": "Homens", "unidade": "un", "nivel": 1}]}
    ],
}
PERIODS = [
    {"id": "202301", "literals": ["janeiro 2023", "1/2023"], "modificacao": "15/02/2023"},
    {"id": "202302", "literals": ["fevereiro 2023"], "modificacao": "2023-03-15"},
]
INDEX = [{"id": "CD", "nome": "Censo", "agregados": [{"id": 1705, "nome": "População"}]}, {"id": "XX", "nome": "Nada", "agregados": []}]


def place(level, loc_id):
    return {"id": loc_id, "nome": f"Lugar {loc_id}", "nivel": {"id": level, "nome": f"Nível {level}"}}


def landed(tmp_path):
    cube = tmp_path / "agregados" / "1705"
    cube.mkdir(parents=True)
    (tmp_path / "acervos").mkdir()
    files = {
        cube / "metadados.json": METADATA,
        cube / "periodos.json": PERIODS,
        # the country comes twice, as it does when a level is declared in two groups
        cube / "localidades_N1.json": [place("N1", "1"), place("N1", "1")],
        cube / "localidades_N6.json": [place("N6", i) for i in ("35", "11", "22")],
        tmp_path / "agregados" / "indice_pesquisas.json": INDEX,
        tmp_path / "acervos" / "A.json": [{"id": 1, "literals": ["Demografia"]}, "solto"],
    }
    for path, content in files.items():
        path.write_text(json.dumps(content, ensure_ascii=False), encoding="utf-8")
    broken = tmp_path / "agregados" / "9"
    broken.mkdir()
    (broken / "periodos.json").write_text('{"status": 500}')
    return str(tmp_path)


def test_documents(spark, tmp_path):
    root = landed(tmp_path)
    row = documents.read_metadata(spark, root).first()
    assert (row.id, row.url, row.pesquisa.id, row.pesquisa.nome) == (1705, "http://x/1705", "", "Censo")
    assert (row.nivel_territorial.administrativo, row.nivel_territorial.ibge) == (["N1", "N6"], ["N1"])
    assert row.periodicidade.inicio == "202301" and row.classificacoes[0].categorias[1].unidade == "un"
    assert [r.id for r in documents.read_survey_index(spark, root).collect()] == ["CD", "XX"]
    bad = documents.unreadable_documents(spark, root).collect()
    assert [r.agregado_id for r in bad] == [9]
    items = documents.read_collections(spark, root)
    first = items.where("ord = 0").select("acervo", F.try_variant_get("item", "$.literals[0]", "string")).first()
    assert tuple(first) == ("A", "Demografia") and items.count() == 2


def test_catalog_from_documents(spark, tmp_path):
    catalog = documents.catalog_from_documents(spark, landed(tmp_path))
    summary = stats.cube_summary(catalog).first()
    assert summary.stat_localidades == {"N1": 1, "N6": 3}
    assert (summary.n_dimensoes, summary.n_periodos, summary.total_size) == (2, 2, 16)
    places = assemble.assembled_localities(catalog).orderBy("nivel_ord", "ord").collect()
    assert [r.loc_id for r in places] == ["1", "35", "11", "22"]
    batches = plan_chunks(catalog, limit=4).where("nivel_territorial = 'N6'").orderBy("chunk_seq").collect()
    assert [c.territorios[0].v for c in batches[:2]] == [["35", "11"], ["22"]]


def test_assembled_cubes_and_snapshots(spark, tmp_path):
    catalog = documents.catalog_from_documents(spark, landed(tmp_path))
    parts = assemble.assemble_cubes(catalog, part_size=2)
    rows = parts.orderBy("id", "parte").collect()
    assert [p.parte for p in rows] == [0, 1, 2]
    assert [[loc.id for loc in p.localidades] for p in rows] == [["1"], ["35", "11"], ["22"]]
    head = rows[0]
    assert [p.data_fim for p in head.periodos] == [dt.date(2023, 1, 31), dt.date(2023, 2, 28)]
    assert [p.modificacao for p in head.periodos] == [dt.date(2023, 2, 15), dt.date(2023, 3, 15)]
    assert head.nivel_territorial.especial == ["N9"] and head.classificacoes[0].nome == "Sexo"
    assert rows[1].variaveis is None and rows[1].periodos is None

    path = str(tmp_path / "cubos")
    sinks.save_snapshot(parts, path)
    (file,) = (tmp_path / "cubos").glob("dados/arquivo=0/part-*")
    text = file.read_text()
    assert "População" in text and '"modificacao":"2023-02-15"' in text
    loaded = sinks.load_snapshot(spark, path)
    assert sorted(r.parte for r in loaded.collect()) == [0, 1, 2]
    again = sinks.snapshot_periods(loaded).orderBy("ord").collect()
    assert [(p.per_id, p.frequencia, p.mes) for p in again] == [("202301", "mensal", 1), ("202302", "mensal", 2)]
    for k, manifest in enumerate(sinks.snapshot_manifests(spark, path, "fonte").orderBy("parte").collect()):
        own = file.read_bytes()[manifest.inicio : manifest.inicio + manifest.size_bytes]
        assert json.loads(own)["parte"] == manifest.parte == k and own.endswith(b"\n")
        assert manifest.sha256 == hashlib.sha256(own).hexdigest()
        assert (manifest.dataset_id, manifest.path) == ("1705", "agregados/agregado_1705.json")
    manifest = sinks.snapshot_manifests(spark, path, "fonte").where("parte = 0").first()
    assert manifest.url == "http://x/1705"
    assert manifest.metadata == {"nome": "População", "pesquisa": "Censo"}


def test_requests_for_metadata(spark, tmp_path):
    catalog = documents.catalog_from_documents(spark, landed(tmp_path))
    urls = {r.url for r in assemble.metadata_urls(catalog, "http://x/agregados").collect()}
    assert urls == {
        f"http://x/agregados/1705/{end}"
        for end in ("metadados", "periodos", "localidades/N1", "localidades/N6", "localidades/N9")
    }
    kinds = spark.createDataFrame([("N",), ("Z",)], "k string")
    got = [r[0] for r in kinds.select(assemble.collection_url(F.col("k"), "http://x/agregados")).collect()]
    assert got == ["http://x/agregados?acervo=N", None]
    assert assemble.index_url("http://x/agregados") == "http://x/agregados"
    paths = kinds.select(sinks.cube_path(F.lit(7)), sinks.values_path(F.lit(7), F.lit("N3"))).first()
    assert tuple(paths) == ("agregados/agregado_7.json", "agregados/7/dados_N3.ndjson")


def test_paths_of_items_of_any_shape(spark):
    items = ['{"id": 1, "x": {"y": [1, {"z": null}], "w": {}}}', '[["a"], [], 2.5]', '"plain"', "{}", '{"id": "b"}', "true"]
    rows = [("K", text) for text in items[:4]] + [("L", text) for text in items[4:]]
    table = spark.createDataFrame(rows, "acervo string, value string").selectExpr("acervo", "try_parse_json(value) AS item")
    found = {(r.acervo, r.caminho, r.valor) for r in documents.collection_paths(table).collect()}
    assert found == {
        ("K", "$.id", "1"), ("K", "$.x.y[]", "1"), ("K", "$.x.y[].z", None), ("K", "$.x.w", "{}"), ("K", "$[][]", "a"),
        ("K", "$[]", "[]"), ("K", "$[]", "2.5"), ("K", "$", "plain"), ("K", "$", "{}"), ("L", "$.id", "b"), ("L", "$", "true"),
    }
    assert {r.acervo for r in documents.collection_shapes(table).collect()} == {"K", "L"}
    assert documents.collection_paths(table.limit(0)).count() == 0


def test_places_are_parsed_once(spark):
    """Each of both uses of the ordinals parsed all documents, and sorted the texts before they were dealt."""
    rows = [
        ("/agregados/7/localidades_N6_1.json", json.dumps([place("N6", "9"), place("N6", "3") | {"nome": "outro"}])),
        ("/agregados/7/localidades_N6_0.json", json.dumps([place("N6", i) for i in ("8", "3", "5")])),
        ("/agregados/8/localidades_N1.json", json.dumps([place("N1", "1"), place("N1", "1") | {"nome": "outro"}])),
    ]
    found = documents.localities_of(documents.landed_documents(spark.createDataFrame(rows, "caminho string, body string"), documents.LOCALITIES))
    numbered = sorted((r["agregado_id"], r["ord"], r["loc_id"], r["nome"], r["nivel_nome"]) for r in found.collect())
    assert numbered == [
        (7, 0, "8", "Lugar 8", "Nível N6"), (7, 1, "3", "Lugar 3", "Nível N6"), (7, 2, "5", "Lugar 5", "Nível N6"),
        (7, 3, "9", "Lugar 9", "Nível N6"), (8, 0, "1", "Lugar 1", "Nível N1"),
    ]
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Generate posexplode") == 1
