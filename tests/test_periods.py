import datetime as dt

import pytest
from pyspark.sql import functions as F

from cubagem.functions import periods as P

D = dt.date
CASES = [
    # literal, frequency, start, end, year, month, quarter, half, last year
    ("janeiro de 2023", "mensal", D(2023, 1, 1), D(2023, 1, 31), 2023, 1, None, None, None),
    ("JANEIRO DE 2023", "mensal", D(2023, 1, 1), D(2023, 1, 31), 2023, 1, None, None, None),
    ("janeiro 2023", "mensal", D(2023, 1, 1), D(2023, 1, 31), 2023, 1, None, None, None),
    ("MARÇO DE 2024", "mensal", D(2024, 3, 1), D(2024, 3, 31), 2024, 3, None, None, None),
    ("fevereiro 2024\n", "mensal", D(2024, 2, 1), D(2024, 2, 29), 2024, 2, None, None, None),
    ("2º trimestre de 2023", "trimestral", D(2023, 4, 1), D(2023, 6, 30), 2023, None, 2, None, None),
    ("jan-fev-mar 2023", "trimestre_movel", D(2023, 1, 1), D(2023, 3, 31), 2023, 3, None, None, None),
    ("dez-jan-fev de 2023", "trimestre_movel", D(2023, 12, 1), D(2024, 2, 29), 2023, 2, None, None, None),
    ("1º semestre de 2023", "semestral", D(2023, 1, 1), D(2023, 6, 30), 2023, None, None, 1, None),
    ("2º SEMESTRE 2023", "semestral", D(2023, 7, 1), D(2023, 12, 31), 2023, None, None, 2, None),
    ("2023", "anual", D(2023, 1, 1), D(2023, 12, 31), 2023, None, None, None, None),
    ("2023/2023", "anual", D(2023, 1, 1), D(2023, 12, 31), 2023, None, None, None, None),
    ("2020/2023", "plurianual", D(2020, 1, 1), D(2023, 12, 31), 2020, None, None, None, 2023),
    ("2023/2020", "plurianual", D(2023, 1, 1), D(2020, 12, 31), 2023, None, None, None, 2020),
]
UNKNOWN = [
    "unknown format", "5º trimestre 2023", "0º semestre 2023", "3º semestre de 2023", "0000",
    "2020/0000", "janeiro", "janeiro  2023", " janeiro 2023", "janeiro 2023 ", "janeiro 23",
    "2023\n\n", "2023\r", "/2023", "20202023", "x/2023", "+023", "", "jan-mar-fev 2023",
]


def parsed(spark, literals, **options):
    df = spark.createDataFrame([(i, lit) for i, lit in enumerate(literals)], "i int, literals array<string>")
    columns = ["frequencia", "data_inicio", "data_fim", "ano", "mes", "trimestre", "semestre", "ano_fim"]
    return [tuple(r) for r in P.parse_periods(df, **options).orderBy("i").select(*columns).collect()]


def test_known_literals(spark):
    assert parsed(spark, [[case[0]] for case in CASES]) == [case[1:] for case in CASES]


def test_unknown_literals(spark):
    rows = parsed(spark, [[text] for text in UNKNOWN] + [[], None])
    assert set(rows) == {("nao_reconhecida", *[None] * 7)}


def test_every_label_and_year_boundary(spark):
    rolling = [P.rolling_label(m) for m in range(1, 13)]
    rows = parsed(spark, [[f"{name} 2022"] for name in P.MONTHS + rolling])
    for month, row in enumerate(rows[:12], 1):
        assert row[1] == D(2022, month, 1) and row[4] == month
        assert row[2] + dt.timedelta(days=1) == (D(2022, month + 1, 1) if month < 12 else D(2023, 1, 1))
    for month, row in enumerate(rows[12:], 1):
        end = row[2] + dt.timedelta(days=1)
        assert (end.year * 12 + end.month) - (2022 * 12 + month) == 3
        assert row[3] == 2022 and row[4] == row[2].month


def test_strict_rejects_impossible_periods_only(spark):
    assert parsed(spark, [["2023"], ["palavra"]], strict=True)[1][0] == "nao_reconhecida"
    for text in ("5º trimestre 2023", "0000"):
        with pytest.raises(Exception, match="impossible period"):
            parsed(spark, [[text]], strict=True)


def test_dates(spark):
    texts = {
        "15/01/2023": D(2023, 1, 15), "1/2/2023": D(2023, 2, 1), "2023-01-15": D(2023, 1, 15),
        "20230115": D(2023, 1, 15), "2023-W01-1": D(2023, 1, 2), "2020W537": D(2021, 1, 3),
        "2021-W53-1": None, "31/02/2023": None, "2023-13-01": None, "ontem": None, "": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.d for r in df.select("t", P.parse_date(F.col("t")).alias("d")).collect()} == texts
    with pytest.raises(Exception, match="not a date"):
        df.select(P.parse_date(F.col("t"), strict=True)).collect()


def test_conformity(spark):
    cases = {
        ("Mensal", "mensal"): True, ("  mensal\t", "mensal"): True, ("mensal", "anual"): False,
        ("TRIMESTRAL MÓVEL", "trimestre_movel"): True, ("trimestral", "trimestre_movel"): False,
        ("anual", "plurianual"): True, ("decenal", "anual"): True, ("semestral", "semestral"): True,
        (None, "x"): True, ("", "x"): True, ("quinzenal", "x"): True, ("mensal", None): False,
    }
    df = spark.createDataFrame(list(cases), "p string, f string")
    rows = df.select("p", "f", P.conforms(F.col("p"), F.col("f")).alias("ok")).collect()
    assert {(r.p, r.f): r.ok for r in rows} == cases
    kept = P.conforming_periods(df, "p", "f")
    assert kept.count() == sum(cases.values())
