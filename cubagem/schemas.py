"""Record schemas of the statistics catalog, as DDL texts.

Field names follow the JSON documents of the statistics service, because they
are what a reader of those documents expects to find in the tables.
"""

from __future__ import annotations

SURVEY_INDEX = "id string, nome string, agregados array<struct<id: bigint, nome: string>>"

VARIABLE = "struct<id: bigint, nome: string, unidade: string, sumarizacao: array<string>>"
CATEGORY = "struct<id: bigint, nome: string, unidade: string, nivel: int>"
CLASSIFICATION = (
    "struct<id: bigint, nome: string,"
    " sumarizacao: struct<status: boolean, excecao: array<bigint>>,"
    f" categorias: array<{CATEGORY}>>"
)

# One metadata document of the service, with its own key spelling.
RAW_METADATA = (
    "id bigint, nome string, URL string, pesquisa string, assunto string,"
    " periodicidade struct<frequencia: string, inicio: string, fim: string>,"
    " nivelTerritorial struct<Administrativo: array<string>, Especial: array<string>,"
    " IBGE: array<string>>,"
    f" variaveis array<{VARIABLE}>, classificacoes array<{CLASSIFICATION}>"
)

RAW_PERIODS = "array<struct<id: string, literals: array<string>, modificacao: string>>"

LOCALITY = "struct<id: string, nome: string, nivel: struct<id: string, nome: string>>"
RAW_LOCALITIES = f"array<{LOCALITY}>"

PAYLOAD = "array<map<string, string>>"

PERIOD = (
    "struct<id: string, literals: array<string>, modificacao: date, frequencia: string,"
    " data_inicio: date, data_fim: date, ano: int, mes: int, trimestre: int, semestre: int,"
    " ano_fim: int>"
)

# One part of an assembled cube (see operators/assemble.py).
ASSEMBLED_CUBE = (
    "parte bigint, id bigint, nome string, url string,"
    " pesquisa struct<id: string, nome: string>, assunto string,"
    " periodicidade struct<frequencia: string, inicio: string, fim: string>,"
    " nivel_territorial struct<administrativo: array<string>, especial: array<string>,"
    " ibge: array<string>>,"
    f" variaveis array<{VARIABLE}>, classificacoes array<{CLASSIFICATION}>,"
    f" periodos array<{PERIOD}>, localidades array<{LOCALITY}>"
)

# Fixed values of the service: request formats, precisions, collection kinds and
# the largest number of values one request may return.
FORMATS = ["a", "c", "n", "u"]
PRECISIONS = ["s", "m", *[str(digits) for digits in range(21)]]
COLLECTION_KINDS = ["A", "C", "N", "P", "E", "V"]
VALUES_LIMIT = 100_000
