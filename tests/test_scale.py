"""What keeps large inputs small: cells that travel folded, members dealt before they are grouped, compressed files."""

from pathlib import Path

from pyspark.sql import functions as F

from cubagem import queries, session
from cubagem.operators import ingest
from cubagem.plans import chunks
from cubagem.sources import packed, sinks, star
from tests.cubes import Cube, catalog


def test_folded_cells_are_located_like_single_ones(spark):
    """Variables share a row only where they share a chunk; an unknown one is a stray of its own."""
    source = catalog(spark, [Cube(1, periods=2, localities={"N1": 3}, variables=3, categories=(2,))])
    rows = [("N1", f"20000{p}", place, [v, 9], [100 * k + 100 if k else 0]) for p in (1, 2, 3) for place in (0, 2, 5) for v in range(3) for k in (0, 1)]
    table = spark.createDataFrame(rows, "nivel_territorial string, per_id string, loc_ord bigint, vs array<bigint>, categorias array<bigint>")
    folded = table.withColumn("agregado_id", F.lit(1).cast("bigint")).withColumn("valores", F.transform("vs", lambda v: F.struct(v.alias("var_id")))).drop("vs")
    single = folded.select("*", F.explode("valores.var_id").alias("var_id")).drop("valores")
    key = ["per_id", "loc_ord", "categorias", "var_id", "chunk_id"]
    for limit in (1, 6, 1000):
        levels = chunks.plan_levels(source, limit=limit)
        one = chunks.locate_cells(levels, single).select(*key).collect()
        many = chunks.locate_cells(levels, folded, folded="valores")
        assert sorted(map(str, many.select("*", F.explode("valores.var_id").alias("var_id")).select(*key).collect())) == sorted(map(str, one))
        assert limit < 1000 or many.count() == 2 * len(rows)


def test_members_of_many_cubes_are_not_in_one_task(spark, tmp_path):
    """AQE merged the groups into one task, which held the members of all cubes."""
    items = [(i, 0, i % 40, 1, 1.0, 1.0, 0.0, 0.0, "N", "O", None) for i in range(400)]
    tables = {
        "lineitem": items,
        "orders": [(i, i % 50, None, "1-URGENT") for i in range(400)],
        "customer": [(i, i % 5, "X") for i in range(50)],
        "nation": [(i, f"n{i}", i % 2) for i in range(5)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, star.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    found = star.members(spark, str(tmp_path), "local")
    found.write.parquet(str(tmp_path / "membros"))
    assert len(list(Path(tmp_path / "membros").glob("part-*"))) > 4
    expected = {(i % 40 + 1, level, str(key)) for i in range(400) for level, key in (("N6", i % 50), ("N3", i % 50 % 5), ("N1", i % 50 % 5 % 2))}
    assert {(r.agregado_id, r.grupo, r.chave) for r in found.collect()} == expected and found.count() == len(expected)


def test_compressed_values_are_read_by_the_same_places(spark, tmp_path):
    bodies = [(f"{c}-N1-0", True, '[{"V":"Válor"},' + ",".join(f'{{"V":"{c}{i}"}}' for i in range(9)) + "]") for c in range(1, 8)]
    records = ingest.payload_records(spark.createDataFrame(bodies, "chunk_id string, cabecalho boolean, body string"))
    made = {}
    for compressed in (False, True):
        path = str(tmp_path / f"valores{compressed}")
        sinks.write_values(records, path, header=True, block_lines=4, file_bytes=200, compressed=compressed)
        names = [f.name for f in Path(path).glob("dados/arquivo=*/part-*")]
        assert len(names) > 1 and all(n.endswith(".gz") == compressed for n in names)
        assert packed.damaged_blocks(spark, path).count() == 0
        values = sinks.read_values(spark, path, block_lines=4).collect()
        index = packed.index(spark, path).collect()
        made[compressed] = sorted(map(str, values)), sorted((r.agregado_id, r.bloco, r.arquivo, r.inicio, r.bytes, r.sha256) for r in index)
    assert made[True] == made[False] and len(made[True][0]) == 70


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chunks_are_made_after_the_last_shuffle(spark):
    """Every choice of categories went through a shuffle, with all that its level has."""
    source = catalog(spark, [Cube(1, periods=6, localities={"N6": 40, "N1": 2}, variables=3, categories=(30, 2))])
    text = plan_text(chunks.plan_chunks(source, limit=1))
    made = text[: text.index("Join")]
    assert made.count("Generate") == 2 and "Exchange" not in made


def test_units_of_any_size_make_the_same_plan(spark, monkeypatch):
    """A unit holds several batches, one, or a part of one."""
    cubes = [
        Cube(1, periods=5, localities={"N1": 2, "N6": 11}, variables=3, categories=(4, 3)),
        Cube(2, periods=1, localities={"N3": 7}, variables=1, categories=()),
        Cube(3, periods=2, localities={"N3": 1}, variables=2, categories=(7, 0)),
    ]
    source = catalog(spark, cubes)
    for limit in (1, 30):
        plans = []
        for unit in (1 << 14, 7):
            monkeypatch.setattr(chunks, "UNIT", unit)
            plans.append(sorted(map(str, chunks.plan_chunks(source, limit=limit).collect())))
        counts = {(r.agregado_id, r.nivel_territorial): r.n_chunks for r in chunks.plan_levels(source, limit=limit).collect()}
        assert plans[0] == plans[1] and len(plans[0]) == sum(counts.values())
        firsts = {(r.agregado_id, r.nivel_territorial) for r in chunks.first_requests(source, limit=limit).collect()}
        assert firsts == set(counts)


def test_a_damaged_plan_is_made_once(spark):
    """Each kind of damage made the whole plan again."""
    cubes = [Cube(i, periods=3, localities={"N1": 2, "N3": 5, "N6": 9}, variables=2, categories=(2,)) for i in (1, 3, 4, 5, 7, 11)]
    text = plan_text(queries.plan_coverage_damaged(catalog(spark, cubes)))
    assert sum("Generate explode(sequence(greatest" in line for line in text.splitlines()) == 1


def test_more_sales_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    """What a task held grew with the sales, since partitions did not."""
    path = str(tmp_path / "lineitem.parquet")
    spark.range(1000).write.parquet(path)
    assert star.large_width(spark, str(tmp_path)) is None and session.fine_width(spark, path) == session.fine_width(spark)
    monkeypatch.setattr(session, "FINE_BYTES", -(-session.file_bytes(spark, path) // 30))
    parts = star.large_width(spark, str(tmp_path))
    assert parts > session.fine_width(spark) and abs(parts - 30) <= 1
    places = spark.createDataFrame([(i % 2 + 1, "local", "N6", str(i), None) for i in range(0, 400, 3)], "agregado_id bigint, tipo string, grupo string, chave string, ultimo date")
    plain, dealt = star.localities(places), star.localities(places, parts)
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))
    assert f", {parts}), REPARTITION_BY_NUM" in plan_text(dealt)


def test_dealing_large_sales_takes_no_memory_of_the_writer(spark, monkeypatch):
    """A task held all line items it read, to sort them, once there were more than 200 MiB of them."""
    for mib, least, most in ((10, 0, 200), (645, 200, 200), (3870, 200, 200), (20 << 10, 640, 640)):
        monkeypatch.setattr(session, "file_bytes", lambda *_, mib=mib: mib << 20)
        parts = star.large_width(spark, "x") or session.fine_width(spark)
        assert max(session.fine_width(spark), least) <= parts <= max(session.fine_width(spark), most)
    monkeypatch.setattr(session, "shuffle_width", lambda _: 200)
    monkeypatch.setattr(session, "file_bytes", lambda *_: 645 << 20)
    assert star.large_width(spark, "x") == 200  # given, so AQE does not merge them


def test_no_method_of_parsed_texts_is_too_long_for_the_jvm(spark, tmp_path):
    """All texts were parsed by one method of more than 8,000 bytes, which is not compiled."""
    spark.createDataFrame([(1, 1, None, "x")], star.TABLES["orders"]).write.parquet(str(tmp_path / "orders.parquet"))
    plan = queries.parse_period_texts(spark, str(tmp_path))._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    codes = debug.codegenStringSeq(plan)
    sizes = [codes.apply(i)._3().maxMethodCodeSize() for i in range(codes.size())]
    assert sizes and max(sizes) < 8000


def shuffle_files(spark) -> list[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return [n for n in names if n.startswith("shuffle_") and n.endswith(".data")]


def test_a_step_of_its_own_leaves_no_shuffle(spark, tmp_path):
    """The shuffles of all steps stayed on the disk until the last had ended."""
    rows = spark.range(1000).repartition(7, "id")
    before = set(shuffle_files(spark))
    with session.own_step(spark):
        rows.write.parquet(str(tmp_path / "a"))
    assert set(shuffle_files(spark)) <= before
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    rows.write.parquet(str(tmp_path / "b"))
    assert set(shuffle_files(spark)) - before
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1000


def test_only_bodies_of_repeated_chunks_are_moved(spark, tmp_path):
    """All bodies were shuffled, twice, since Spark could not know how few ids come again."""
    path = str(tmp_path / "pouso")
    ids = F.when(F.col("id") < 2, "1-N1-0").otherwise(F.concat(F.lit("1-N1-"), F.col("id").cast("string")))
    body = F.concat(F.lit('[{"V":"'), *[F.sha2((F.col("id") + k).cast("string"), 512) for k in range(20)], F.lit('"}]'))
    spark.range(300).select(ids.alias("chunk_id"), F.lit(True).alias("cabecalho"), body.alias("body")).write.parquet(path)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        kept = ingest.one_per_chunk(spark.read.parquet(path))
        assert "SortMergeJoin" not in plan_text(kept)
        assert kept.count() == 299 and kept.select("chunk_id").distinct().count() == 299
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_cells_are_dealt_once(spark, tmp_path):
    """Cells were shuffled by cube, by place, by level and by chunk; cells without a chunk still share one payload."""
    from datetime import datetime

    tables = {
        "lineitem": [(i, 0, i % 6, 1 + i % 3, 1.0 + i, 2.0, 0.0, 0.0, "N", "O", None) for i in range(60)],
        "orders": [(i, i % 5, None if i % 10 == 9 else datetime(1998, 1 + i % 4, 3), "1-URGENT") for i in range(60)],
        "customer": [(i, i % 5, "X") for i in range(5)],
        "supplier": [(i, f"s{i}", i % 5) for i in range(6)],
        "nation": [(i, f"n{i}", i % 5) for i in range(5)],
        "region": [(i, f"r{i}") for i in range(5)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, star.TABLES[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    source = star.catalog_from_star(spark, str(tmp_path))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with session.own_step(spark):
            cells = star.located_cells(spark, str(tmp_path), source)
            grouped = cells.groupBy("agregado_id", "chunk_id").agg(F.collect_list("valores").alias("v"))
            text = plan_text(grouped)
        after = text[: text.index("l_suppkey")]
        assert "loc_id" in after and not [line for line in after.splitlines() if "hashpartitioning(chunk_id" in line]
        assert not [line for line in after.splitlines() if "hashpartitioning" in line and "loc_id" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    landed = star.landed_payloads(spark, str(tmp_path), source).collect()
    strays = [r.body for r in landed if r.chunk_id is None]
    dims = {len(star.REGION_CLASSIFICATIONS[i % 6 % 5]) for i in range(9, 60, 10)}
    assert len(strays) == len(dims)
    # Three levels and four variables of each sale without a date, and one row of labels in each payload.
    assert sum(body.count('"V":') for body in strays) <= 6 * 3 * 4 + len(strays)
    names = [r.chunk_id for r in landed if r.chunk_id is not None]
    assert {n for n in names if n.startswith("cubo")} == {f"cubo {i}" for i in range(1, 7)}


def test_cutting_a_block_does_not_read_the_whole_file(spark, tmp_path):
    """Each block copied the bytes of its whole file, so time grew with the square of a file."""
    lines = spark.range(50).select(F.lit(1).cast("bigint").alias("id"), F.col("id").alias("posicao"), F.col("id").cast("string").alias("linha"))
    path = str(tmp_path / "valores")
    packed.pack_lines(lines, ["id"], path, block_lines=4)
    blocks = packed.read_blocks(spark, path)
    assert "substring(content" not in plan_text(blocks)
    assert b"".join(r.conteudo for r in blocks.orderBy("bloco").collect()) == b"".join(b"%d\n" % i for i in range(50))
