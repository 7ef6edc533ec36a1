"""Small catalogs with chosen counts, and what their chunks cover."""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from cubagem.catalog import Catalog


@dataclass
class Cube:
    id: int
    periods: int = 1
    localities: dict[str, int] = field(default_factory=lambda: {"N1": 1})
    variables: int = 1
    categories: tuple[int, ...] = ()
    special: list[str] = field(default_factory=list)

    def pools(self, level: str) -> tuple:
        """Ids of periods, localities, variables and of each classification."""
        return (
            [f"{200001 + i}" for i in range(self.periods)],
            [f"{i + 1}" for i in range(self.localities.get(level, 0))],
            [f"{i}" for i in range(self.variables)],
            [[f"{100 * c + k if k else 0}" for k in range(n)] for c, n in enumerate(self.categories, 1)],
        )


def catalog(spark, cubes: list[Cube]) -> Catalog:
    def table(rows, schema):
        return spark.createDataFrame(list(rows), schema)

    return Catalog(
        cubes=table(
            [(c.id, f"Cubo {c.id}", f"/{c.id}", "P1", "Pesquisa 1", "Assunto", "mensal", "a", "z") for c in cubes],
            "agregado_id bigint, nome string, url string, pesquisa_id string, pesquisa string,"
            " assunto string, frequencia string, inicio string, fim string",
        ),
        levels=table(
            [
                (c.id, group, level, order)
                for c in cubes
                for order, (group, level) in enumerate(
                    [("administrativo", n) for n in c.localities] + [("especial", n) for n in c.special]
                )
            ],
            "agregado_id bigint, grupo string, nivel string, ord int",
        ),
        localities=table(
            [
                (c.id, level, level, loc_id, f"Lugar {loc_id}", order)
                for c in cubes
                for level in c.localities
                for order, loc_id in enumerate(c.pools(level)[1])
            ],
            "agregado_id bigint, nivel string, nivel_nome string, loc_id string, nome string, ord bigint",
        ),
        variables=table(
            [(c.id, i, f"V{i}", "u", [], i) for c in cubes for i in range(c.variables)],
            "agregado_id bigint, var_id bigint, nome string, unidade string,"
            " sumarizacao array<string>, ord int",
        ),
        classifications=table(
            [(c.id, i + 1, f"C{i + 1}", (True, []), i) for c in cubes for i in range(len(c.categories))],
            "agregado_id bigint, class_id bigint, nome string,"
            " sumarizacao struct<status: boolean, excecao: array<bigint>>, ord int",
        ),
        categories=table(
            [
                (c.id, i + 1, int(cat), f"K{cat}", None, 1, order)
                for c in cubes
                for i, ids in enumerate(c.pools("")[3])
                for order, cat in enumerate(ids)
            ],
            "agregado_id bigint, class_id bigint, cat_id bigint, nome string, unidade string,"
            " nivel int, ord int",
        ),
        periods=table(
            [(c.id, p, [p], "01/01/2020", i) for c in cubes for i, p in enumerate(c.pools("")[0])],
            "agregado_id bigint, per_id string, literals array<string>, modificacao string, ord int",
        ),
    )


def covered(chunk, cube: Cube) -> list[tuple]:
    """All cells a chunk asks for; an empty list stands for the whole pool."""
    periods, places, variables, classes = cube.pools(chunk.nivel_territorial)
    chosen = {pair.k: pair.v for pair in chunk.classificacoes}
    axes = [
        chunk.periodos or periods,
        chunk.territorios[0].v or places,
        chunk.variaveis or variables,
        *[chosen[str(i)] or pool for i, pool in enumerate(classes, 1)],
    ]
    return list(itertools.product(*axes))


def cells(cube: Cube, level: str) -> set[tuple]:
    periods, places, variables, classes = cube.pools(level)
    return set(itertools.product(periods, places, variables, *classes))
