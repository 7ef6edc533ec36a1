"""The registered queries once more, as SQL over the input tables.

Written from the definitions and not from the Spark jobs: period queries start
from dates instead of texts, parsed URLs from the columns they were made of,
and plans from the closed form in plain joins.
"""

from __future__ import annotations

import hashlib

CUBES = """
cubes AS (
  SELECT CAST(s_suppkey + 1 AS BIGINT) AS agregado_id,
         'Vendas de ' || s_name AS nome,
         '/agregados/' || CAST(s_suppkey + 1 AS VARCHAR) AS url,
         'P' || CAST(n_nationkey AS VARCHAR) AS pesquisa_id,
         n_name AS pesquisa, r_name AS assunto, r_regionkey AS regiao,
         CASE n_nationkey % 7
           WHEN 0 THEN 'mensal' WHEN 1 THEN 'trimestral' WHEN 2 THEN 'trimestral móvel'
           WHEN 3 THEN 'semestral' WHEN 4 THEN 'anual' WHEN 5 THEN 'decenal'
           ELSE 'sem periodicidade' END AS frequencia
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""

VARIABLES = """
variable_list(var_id, nome, unidade, ord) AS (
  VALUES (101, 'Quantidade', 'Unidades', 0),
         (102, 'Valor das vendas', 'Vide categorias da classificação', 1),
         (103, 'Desconto', 'Percentual', 2), (104, 'Imposto', '', 3)
), variables AS (
  SELECT agregado_id, CAST(var_id AS BIGINT) AS var_id, v.nome, v.unidade, v.ord
  FROM cubes, variable_list v
)"""

CLASSES = """
class_list(regiao, class_id, nome, ord) AS (
  VALUES (1, 10, 'Devolução', 0),
         (2, 20, 'Situação', 0), (2, 30, 'Prioridade', 1),
         (3, 10, 'Devolução', 0), (3, 20, 'Situação', 1), (3, 30, 'Prioridade', 2),
         (4, 10, 'Devolução', 0), (4, 20, 'Situação', 1), (4, 30, 'Prioridade', 2),
         (4, 40, 'Segmento', 3), (4, 50, 'Linha', 4)
), classes AS (
  SELECT agregado_id, CAST(class_id AS BIGINT) AS class_id, c.nome, c.ord
  FROM cubes JOIN class_list c USING (regiao)
)"""

SALES = """
sales AS (
  SELECT CAST(l_suppkey + 1 AS BIGINT) AS agregado_id, lineitem.*, orders.*, c_mktsegment,
         c_nationkey, n_regionkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

CATEGORIES = """
seen AS (
  SELECT DISTINCT agregado_id, 10 AS class_id, l_returnflag AS nome FROM sales
  UNION ALL SELECT DISTINCT agregado_id, 20, l_linestatus FROM sales
  UNION ALL SELECT DISTINCT agregado_id, 30, o_orderpriority FROM sales
  UNION ALL SELECT DISTINCT agregado_id, 40, c_mktsegment FROM sales
  UNION ALL SELECT DISTINCT agregado_id, 50, CAST(l_linenumber AS VARCHAR) FROM sales
), category_list AS (
  SELECT agregado_id, class_id, CAST('0x' || substr(md5(seen.nome), 1, 12) AS BIGINT) AS cat_id, seen.nome,
         CASE WHEN class_id = 50 THEN 2 ELSE 1 END AS nivel
  FROM seen JOIN classes USING (agregado_id, class_id)
  UNION ALL SELECT agregado_id, class_id, 0, 'Total', 0 FROM classes WHERE class_id = 30
), categories AS (
  SELECT *,
         CASE WHEN class_id = 10 AND nome = 'A' THEN 'Reais'
              WHEN class_id = 30 AND cat_id = 0 THEN 'Mil Reais'
              WHEN class_id = 40 AND nome < 'C' THEN ''
              WHEN class_id = 50 AND nome = '7' THEN 'Peças' END AS unidade,
         row_number() OVER (PARTITION BY agregado_id, class_id ORDER BY cat_id) - 1 AS ord
  FROM category_list
)"""

PERIODS = """
months AS (
  SELECT CAST(l_suppkey + 1 AS BIGINT) AS agregado_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS mes, max(o_orderdate) AS ultimo
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
), period_months AS (
  SELECT agregado_id, frequencia, mes, ultimo,
         CASE frequencia
           WHEN 'trimestral' THEN make_date(year(mes), quarter(mes) * 3 - 2, 1)
           WHEN 'semestral' THEN make_date(year(mes), CASE WHEN month(mes) <= 6 THEN 1 ELSE 7 END, 1)
           WHEN 'anual' THEN make_date(year(mes), 1, 1)
           WHEN 'sem periodicidade' THEN make_date(year(mes), 1, 1)
           WHEN 'decenal' THEN make_date(year(mes) - year(mes) % 10, 1, 1)
           ELSE mes END AS inicio
  FROM months JOIN cubes USING (agregado_id)
), period_starts AS (
  SELECT agregado_id, frequencia, inicio, max(ultimo) AS ultimo FROM period_months GROUP BY ALL
), periods AS (
  SELECT agregado_id, frequencia AS periodicidade, inicio, CAST(ultimo AS DATE) AS modificacao,
         CASE frequencia
           WHEN 'trimestral' THEN year(inicio) || lpad(CAST(quarter(inicio) AS VARCHAR), 2, '0')
           WHEN 'semestral' THEN year(inicio) || CASE WHEN month(inicio) = 1 THEN '01' ELSE '02' END
           WHEN 'anual' THEN CAST(year(inicio) AS VARCHAR)
           WHEN 'decenal' THEN CAST(year(inicio) AS VARCHAR)
           WHEN 'sem periodicidade' THEN CAST(year(inicio) AS VARCHAR)
           ELSE strftime(inicio, '%Y%m') END AS per_id,
         row_number() OVER (PARTITION BY agregado_id ORDER BY inicio) - 1 AS ord
  FROM period_starts
)"""

PLACES = """
places AS (
  SELECT DISTINCT agregado_id, 'N1' AS nivel, CAST(n_regionkey AS BIGINT) AS lugar FROM sales
  UNION ALL SELECT DISTINCT agregado_id, 'N3', c_nationkey FROM sales
  UNION ALL SELECT DISTINCT agregado_id, 'N6', o_custkey FROM sales
), localities AS (
  SELECT agregado_id, nivel, CAST(lugar + 1 AS VARCHAR) AS loc_id,
         CASE nivel WHEN 'N1' THEN 'Região ' WHEN 'N3' THEN 'País ' ELSE 'Cliente ' END
           || CAST(lugar AS VARCHAR) AS nome,
         row_number() OVER (PARTITION BY agregado_id, nivel ORDER BY lugar) - 1 AS ord
  FROM places JOIN cubes USING (agregado_id)
)"""

COUNTS = """
class_counts AS (
  SELECT agregado_id, class_id, ord,
         (SELECT count(*) FROM categories k
          WHERE k.agregado_id = c.agregado_id AND k.class_id = c.class_id) AS n
  FROM classes c
), dims AS (
  SELECT agregado_id, count(class_id) AS n_classificacoes,
         CAST(coalesce(product(n), 1) AS BIGINT) AS n_dimensoes
  FROM cubes LEFT JOIN class_counts USING (agregado_id) GROUP BY agregado_id
), level_counts AS (
  SELECT agregado_id, nivel, count(*) AS n_localidades FROM localities GROUP BY ALL
), period_counts AS (
  SELECT agregado_id, count(*) AS n_periodos FROM periods GROUP BY ALL
)"""

ALL = [CUBES, VARIABLES, CLASSES, SALES, CATEGORIES, PERIODS, PLACES, COUNTS]


def with_parts(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def plan_parts(limit: int, n_variables: int = 4) -> str:
    """Levels with their splits, from the counts of the pools.

    ``splits`` has the counts after each step; ``class_splits`` the classifications
    in the order they would be expanded, with the values left before each of them.
    """
    return f"""
plan_counts AS (
  SELECT l.agregado_id, l.nivel, l.n_localidades AS L, {n_variables} AS V,
         coalesce(p.n_periodos, 0) AS P, d.n_dimensoes AS D
  FROM level_counts l JOIN dims d USING (agregado_id)
  LEFT JOIN period_counts p USING (agregado_id)
), plan_p AS (
  SELECT *, P * L * V * D AS total, P * L * V * D > {limit} AND P > 1 AS split_p FROM plan_counts
), plan_l AS (
  SELECT *, CASE WHEN split_p THEN L * V * D ELSE total END AS t1 FROM plan_p
), plan_b AS (
  SELECT *, t1 > {limit} AND L > 1 AS split_l,
         greatest(1, {limit} // greatest(V * D, 1)) AS lote FROM plan_l
), plan_v AS (
  SELECT *, CASE WHEN NOT split_l THEN t1 WHEN lote >= L THEN L * V * D ELSE lote * V * D END AS t2
  FROM plan_b
), splits AS (
  SELECT *, t2 > {limit} AND V > 1 AS split_v,
         CASE WHEN t2 > {limit} AND V > 1 THEN D ELSE t2 END AS t3,
         CASE WHEN split_p THEN P ELSE 1 END AS n_p,
         CASE WHEN split_l THEN (L + lote - 1) // lote ELSE 1 END AS n_b,
         CASE WHEN t2 > {limit} AND V > 1 THEN V ELSE 1 END AS n_v
  FROM plan_v
), class_ranks AS (
  SELECT agregado_id, class_id, ord, n,
         row_number() OVER (PARTITION BY agregado_id ORDER BY n DESC, ord) AS posto
  FROM class_counts
), class_splits AS (
  SELECT s.agregado_id, s.nivel, c.class_id, c.n, c.posto,
         s.t3 / coalesce((SELECT product(b.n) FROM class_ranks b
                          WHERE b.agregado_id = c.agregado_id AND b.posto < c.posto), 1) > {limit}
         AND c.n > 1 AS aberta
  FROM splits s JOIN class_ranks c USING (agregado_id)
), levels AS (
  SELECT s.*, CAST(coalesce(k.n_c, 1) AS BIGINT) AS n_c
  FROM splits s LEFT JOIN (
    SELECT agregado_id, nivel, product(n) AS n_c FROM class_splits WHERE aberta GROUP BY ALL
  ) k USING (agregado_id, nivel)
)"""


# The pools that the restricted plan chooses from, in place of the whole ones.
RESTRICTED = (
    """
all_periods AS (SELECT * FROM periods_whole WHERE per_id >= '1998'), periods AS (
  SELECT * EXCLUDE (ord), row_number() OVER (PARTITION BY agregado_id ORDER BY per_id) - 1 AS ord
  FROM all_periods
)""",
    """
variables AS (
  SELECT * EXCLUDE (ord), row_number() OVER (PARTITION BY agregado_id ORDER BY ord) - 1 AS ord
  FROM variables_whole WHERE var_id IN (101, 103)
)""",
    """
categories AS (
  SELECT * EXCLUDE (ord),
         row_number() OVER (PARTITION BY agregado_id, class_id ORDER BY cat_id) - 1 AS ord
  FROM categories_whole
  WHERE (class_id <> 10 OR nome <> 'R') AND (class_id <> 30 OR cat_id = 0)
)""",
)


def restricted_parts() -> list[str]:
    periods, variables, categories = RESTRICTED
    return [
        CUBES,
        VARIABLES.replace("variables AS", "variables_whole AS"),
        variables,
        CLASSES,
        SALES,
        CATEGORIES.replace("), categories AS", "), categories_whole AS"),
        categories,
        PERIODS.replace("), periods AS", "), periods_whole AS"),
        periods,
        PLACES,
        COUNTS,
    ]


def chunk_sql(limit: int, condition: str = "TRUE", restricted: bool = False) -> str:
    """Every chunk with its number, values and URL."""
    open_periods = open_variables = open_categories = "'all'"
    parts = with_parts(*ALL, plan_parts(limit))
    if restricted:
        parts = with_parts(*restricted_parts(), plan_parts(limit, 2))
        open_variables = "'101,103'"
        open_periods = """(SELECT string_agg(per_id, ',' ORDER BY a.ord) FROM periods a
                           WHERE a.agregado_id = chosen_levels.agregado_id)"""
        some = ",".join(map(str, sorted(int(hashlib.md5(x).hexdigest()[:12], 16) for x in (b"A", b"N"))))
        open_categories = f"""CASE o.class_id WHEN 10 THEN '{some}' WHEN 30 THEN '0' ELSE 'all' END"""
    return (
        parts
        + f""",
chosen_levels AS (SELECT * FROM levels WHERE {condition}),
period_choices AS (
  SELECT agregado_id, nivel, p.ord AS p_i, p.per_id AS texto, 1 AS n
  FROM chosen_levels JOIN periods p USING (agregado_id) WHERE split_p
  UNION ALL SELECT agregado_id, nivel, 0, {open_periods}, P FROM chosen_levels WHERE NOT split_p
), batch_choices AS (
  SELECT agregado_id, nivel, c.ord // lote AS b_i,
         string_agg(c.loc_id, ',' ORDER BY c.ord) AS texto, count(*) AS n
  FROM chosen_levels JOIN localities c USING (agregado_id, nivel) WHERE split_l GROUP BY ALL
  UNION ALL SELECT agregado_id, nivel, 0, 'all', L FROM chosen_levels WHERE NOT split_l
), variable_choices AS (
  SELECT agregado_id, nivel, v.ord AS v_i, CAST(v.var_id AS VARCHAR) AS texto, 1 AS n
  FROM chosen_levels JOIN variables v USING (agregado_id) WHERE split_v
  UNION ALL SELECT agregado_id, nivel, 0, {open_variables}, V FROM chosen_levels WHERE NOT split_v
), class_numbers AS (
  SELECT agregado_id, nivel, unnest(range(n_c)) AS c_i FROM chosen_levels
), open_classes AS (
  SELECT s.*, CAST(coalesce((SELECT product(a.n) FROM class_splits a
                   WHERE a.agregado_id = s.agregado_id AND a.nivel = s.nivel AND a.aberta
                     AND a.posto > s.posto), 1) AS BIGINT) AS passo
  FROM class_splits s
), class_choices AS (
  SELECT m.agregado_id, m.nivel, m.c_i,
         coalesce(string_agg('/c' || o.class_id || '/'
           || CASE WHEN o.aberta THEN CAST(g.cat_id AS VARCHAR) ELSE {open_categories} END, ''
           ORDER BY o.class_id), '') AS texto,
         CAST(coalesce(product(CASE WHEN o.aberta THEN 1 ELSE o.n END), 1) AS BIGINT) AS n
  FROM class_numbers m
  LEFT JOIN open_classes o USING (agregado_id, nivel)
  LEFT JOIN categories g ON g.agregado_id = m.agregado_id AND g.class_id = o.class_id
       AND o.aberta AND g.ord = (m.c_i // o.passo) % o.n
  GROUP BY ALL
), chunks AS (
  SELECT l.agregado_id, l.nivel AS nivel_territorial,
         CAST(((p_i * n_b + b_i) * n_v + v_i) * n_c + c_i AS BIGINT) AS chunk_seq,
         CAST(pc.n * bc.n * vc.n * cc.n AS BIGINT) AS n_valores,
         '/t/' || l.agregado_id || '/n' || substr(l.nivel, 2) || '/' || bc.texto
           || '/v/' || vc.texto || '/p/' || pc.texto || cc.texto || '/h/y/f/a/d/m' AS url,
         split_p, split_l, split_v, n_c
  FROM chosen_levels l
  JOIN period_choices pc USING (agregado_id, nivel) JOIN batch_choices bc USING (agregado_id, nivel)
  JOIN variable_choices vc USING (agregado_id, nivel) JOIN class_choices cc USING (agregado_id, nivel)
)"""
    )


# Sales by cube, place, period and categories, each with the chunk it is in. With the
# default limit these levels are split by period and place only.
CELLS = """
cell_sums AS (
  SELECT s.agregado_id, nivel, lugar, inicio,
         CASE c.regiao
           WHEN 0 THEN '' WHEN 1 THEN rf WHEN 2 THEN ls || ',' || pr
           WHEN 3 THEN rf || ',' || ls || ',' || pr
           ELSE rf || ',' || ls || ',' || pr || ',' || ms || ',' || ln END AS categorias,
         sum(CAST(l_quantity AS DECIMAL(18,2))) AS v101,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v102,
         sum(CAST(l_discount AS DECIMAL(18,2))) AS v103, sum(CAST(l_tax AS DECIMAL(18,2))) AS v104
  FROM (
    SELECT unnest(['N1', 'N3', 'N6']) AS nivel, unnest([n_regionkey, c_nationkey, o_custkey]) AS lugar, *
    FROM (SELECT *, CAST('0x' || substr(md5(l_returnflag), 1, 12) AS BIGINT) || '' AS rf,
                 CAST('0x' || substr(md5(l_linestatus), 1, 12) AS BIGINT) || '' AS ls,
                 CAST('0x' || substr(md5(o_orderpriority), 1, 12) AS BIGINT) || '' AS pr,
                 CAST('0x' || substr(md5(c_mktsegment), 1, 12) AS BIGINT) || '' AS ms,
                 CAST('0x' || substr(md5(CAST(l_linenumber AS VARCHAR)), 1, 12) AS BIGINT) || '' AS ln,
                 CAST(date_trunc('month', o_orderdate) AS DATE) AS mes FROM sales)
  ) s JOIN cubes c ON c.agregado_id = s.agregado_id
  JOIN period_months m ON m.agregado_id = s.agregado_id AND m.mes = s.mes
  GROUP BY ALL
), cells AS (
  SELECT s.agregado_id, s.nivel AS nivel_territorial, l.loc_id, p.per_id, s.categorias,
         v101, v102, v103, v104,
         (CASE WHEN split_p THEN p.ord ELSE 0 END) * n_b
           + CASE WHEN split_l THEN l.ord // lote ELSE 0 END AS chunk_seq,
         s.agregado_id || '-' || s.nivel || '-' || ((CASE WHEN split_p THEN p.ord ELSE 0 END) * n_b
           + CASE WHEN split_l THEN l.ord // lote ELSE 0 END) AS chunk_id
  FROM cell_sums s
  JOIN localities l ON l.agregado_id = s.agregado_id AND l.nivel = s.nivel
       AND l.loc_id = CAST(s.lugar + 1 AS VARCHAR)
  JOIN periods p ON p.agregado_id = s.agregado_id AND p.inicio = s.inicio
  JOIN levels v ON v.agregado_id = s.agregado_id AND v.nivel = s.nivel
), good_cells AS (
  SELECT * FROM cells WHERE NOT (agregado_id % 3 = 0 AND nivel_territorial = 'N1' AND chunk_seq = 0)
), cell_values AS (
  SELECT agregado_id, nivel_territorial, loc_id, per_id, categorias, chunk_id,
         unnest(['101', '102', '103', '104']) AS var_id, unnest([v101, v102, v103, v104]) AS valor
  FROM good_cells
)"""


def _oracles() -> dict[str, str]:
    sql = {}
    pairs = "SELECT pesquisa_id, pesquisa, agregado_id, nome AS agregado FROM cubes"
    sql["flatten_surveys"] = with_parts(CUBES) + pairs
    sql["list_surveys"] = (
        with_parts(CUBES)
        + "SELECT pesquisa_id, pesquisa, count(*) AS n_agregados FROM cubes GROUP BY ALL"
    )
    sql["list_survey_cubes"] = with_parts(CUBES) + pairs + " WHERE pesquisa_id = 'P7'"

    sql["cube_locality_counts"] = (
        with_parts(CUBES, SALES, PLACES)
        + "SELECT agregado_id, nivel, count(*) AS n_localidades FROM localities GROUP BY ALL"
    )
    sql["cube_dimensions"] = (
        with_parts(*ALL) + "SELECT agregado_id, n_classificacoes, n_dimensoes FROM dims"
    )
    sizes = """
, sizes AS (
  SELECT c.pesquisa_id, c.agregado_id, 4 AS n_variaveis, d.n_classificacoes, d.n_dimensoes,
         coalesce(p.n_periodos, 0) AS n_periodos,
         coalesce(l.n_localidades, 0) AS n_localidades,
         coalesce(l.n_niveis, 0) AS n_niveis_territoriais, coalesce(l.texto, '') AS stat_localidades
  FROM cubes c JOIN dims d USING (agregado_id) LEFT JOIN period_counts p USING (agregado_id)
  LEFT JOIN (SELECT agregado_id, CAST(sum(n_localidades) AS BIGINT) AS n_localidades,
                    count(*) AS n_niveis,
                    string_agg(nivel || '=' || n_localidades, ',' ORDER BY nivel) AS texto
             FROM level_counts GROUP BY ALL) l USING (agregado_id)
)
"""
    estimate = """
         n_localidades * n_variaveis * greatest(n_dimensoes, 1) AS period_size,
         n_localidades * n_variaveis * greatest(n_dimensoes, 1) * n_periodos AS total_size"""
    sql["cube_estimate"] = (
        with_parts(*ALL) + sizes + f"SELECT agregado_id, n_dimensoes, {estimate} FROM sizes"
    )
    sql["cube_summary"] = (
        with_parts(*ALL)
        + sizes
        + f"""SELECT pesquisa_id, agregado_id, stat_localidades, n_niveis_territoriais,
         n_localidades, CAST(n_variaveis AS BIGINT) AS n_variaveis, n_classificacoes, n_dimensoes,
         n_periodos, {estimate},
         CAST(n_variaveis * greatest(n_dimensoes, 1) AS BIGINT) AS localidade_size,
         CAST(greatest(n_dimensoes, 1) AS BIGINT) AS variavel_size FROM sizes"""
    )

    sql["cube_info_variables"] = (
        with_parts(CUBES, VARIABLES)
        + "SELECT agregado_id, CAST(ord AS INT) AS ord, var_id, nome, unidade FROM variables"
    )
    sql["cube_info_classifications"] = (
        with_parts(*ALL)
        + """SELECT agregado_id, CAST(k.ord AS INT) AS ord, class_id, c.nome, k.n AS n_categorias
             FROM class_counts k JOIN classes c USING (agregado_id, class_id)"""
    )

    literal = """CASE periodicidade
           WHEN 'mensal' THEN {month} || ' ' || year(inicio)
           WHEN 'trimestral' THEN quarter(inicio) || 'º trimestre ' || year(inicio)
           WHEN 'trimestral móvel' THEN {rolling} || ' de ' || year(inicio)
           WHEN 'semestral' THEN CASE WHEN month(inicio) = 1 THEN '1' ELSE '2' END
                || 'º semestre de ' || year(inicio)
           WHEN 'anual' THEN CAST(year(inicio) AS VARCHAR)
           WHEN 'decenal' THEN year(inicio) || '/' || (year(inicio) + 9)
           ELSE 'edição ' || year(inicio) END""".format(
        month="""['janeiro','fevereiro','março','abril','maio','junho','julho','agosto','setembro',
            'outubro','novembro','dezembro'][month(inicio)]""",
        rolling="""['jan-fev-mar','fev-mar-abr','mar-abr-mai','abr-mai-jun','mai-jun-jul',
            'jun-jul-ago','jul-ago-set','ago-set-out','set-out-nov','out-nov-dez','nov-dez-jan',
            'dez-jan-fev'][month(inicio)]""",
    )
    sql["cube_periods"] = (
        with_parts(CUBES, PERIODS)
        + f"SELECT agregado_id, ord, per_id, {literal} AS nome, modificacao FROM periods"
    )

    parsed = """
, parsed AS (
  SELECT agregado_id, per_id, periodicidade, modificacao,
         CASE periodicidade WHEN 'trimestral móvel' THEN 'trimestre_movel'
              WHEN 'decenal' THEN 'plurianual' WHEN 'sem periodicidade' THEN 'nao_reconhecida'
              ELSE periodicidade END AS frequencia,
         CASE WHEN periodicidade <> 'sem periodicidade' THEN inicio END AS data_inicio,
         CAST(CASE periodicidade
           WHEN 'mensal' THEN inicio + INTERVAL 1 MONTH
           WHEN 'trimestral' THEN inicio + INTERVAL 3 MONTH
           WHEN 'trimestral móvel' THEN inicio + INTERVAL 3 MONTH
           WHEN 'semestral' THEN inicio + INTERVAL 6 MONTH
           WHEN 'anual' THEN inicio + INTERVAL 12 MONTH
           WHEN 'decenal' THEN inicio + INTERVAL 120 MONTH END - INTERVAL 1 DAY AS DATE) AS data_fim,
         CAST(CASE WHEN periodicidade <> 'sem periodicidade' THEN year(inicio) END AS INT) AS ano,
         CAST(CASE periodicidade WHEN 'mensal' THEN month(inicio)
              WHEN 'trimestral móvel' THEN month(inicio + INTERVAL 2 MONTH) END AS INT) AS mes,
         CAST(CASE WHEN periodicidade = 'trimestral' THEN quarter(inicio) END AS INT) AS trimestre,
         CAST(CASE WHEN periodicidade = 'semestral' THEN (month(inicio) + 5) // 6 END AS INT)
           AS semestre,
         CAST(CASE WHEN periodicidade = 'decenal' THEN year(inicio) + 9 END AS INT) AS ano_fim
  FROM periods
)
"""
    fields = (
        "agregado_id, per_id, frequencia, modificacao, data_inicio, data_fim, ano, mes, trimestre,"
        " semestre, ano_fim"
    )
    for name, frequency in PERIOD_QUERIES.items():
        sql[name] = (
            with_parts(CUBES, PERIODS)
            + parsed
            + f"SELECT {fields} FROM parsed WHERE frequencia = '{frequency}'"
        )
    sql["parse_period_texts"] = f"""
SELECT o_orderkey,
       strftime(o_orderdate, '%Y-%m-%d') || '|' ||
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || '|' ||
       strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y-%m-%d')
       || '|' || month(o_orderdate) AS mensal,
       strftime(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d')
         AS trimestre_fim,
       strftime(date_trunc('month', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y-%m-%d')
         AS movel_fim
FROM orders"""
    # Each period of a cube is offered to the two neighbouring periodicities as well.
    sql["period_conformity"] = (
        with_parts(CUBES, PERIODS)
        + parsed
        + """, offered AS (
  SELECT p.*, o.nome AS oferta FROM parsed p, (VALUES (' Mensal '), ('TRIMESTRAL'),
    ('trimestral móvel'), ('Semestral'), ('anual'), ('decenal'), (''), ('quinzenal')) o(nome)
)
SELECT agregado_id, per_id, oferta, frequencia FROM offered
WHERE oferta IN ('', 'quinzenal') OR frequencia = CASE oferta WHEN ' Mensal ' THEN 'mensal'
      WHEN 'TRIMESTRAL' THEN 'trimestral' WHEN 'trimestral móvel' THEN 'trimestre_movel'
      WHEN 'Semestral' THEN 'semestral' ELSE 'anual' END
   OR (oferta IN ('anual', 'decenal') AND frequencia = 'plurianual')"""
    )

    flat = """
, category_axis AS (
  SELECT c.agregado_id, c.class_id, c.ord AS class_ord, c.nome AS dim_nome,
         k.cat_id, k.nome AS cat_nome, k.unidade, k.nivel, k.ord
  FROM classes c JOIN categories k USING (agregado_id, class_id)
), d0 AS (SELECT * FROM category_axis WHERE class_ord = 0),
d1 AS (SELECT * FROM category_axis WHERE class_ord = 1),
d2 AS (SELECT * FROM category_axis WHERE class_ord = 2),
d3 AS (SELECT * FROM category_axis WHERE class_ord = 3),
d4 AS (SELECT * FROM category_axis WHERE class_ord = 4),
flat AS (
  SELECT c.agregado_id, c.nome AS agregado, c.pesquisa, c.assunto, c.frequencia,
         c.url AS url_agregado, v.var_id AS D4C, v.nome AS D4N, v.unidade AS var_unidade,
         d.n_classificacoes AS n,
         d0.class_id AS D5C, d0.dim_nome AS D5N, d0.cat_id AS C5C, d0.cat_nome AS C5N,
         d1.class_id AS D6C, d1.dim_nome AS D6N, d1.cat_id AS C6C, d1.cat_nome AS C6N,
         d2.class_id AS D7C, d2.dim_nome AS D7N, d2.cat_id AS C7C, d2.cat_nome AS C7N,
         d3.class_id AS D8C, d3.dim_nome AS D8N, d3.cat_id AS C8C, d3.cat_nome AS C8N,
         d4.class_id AS D9C, d4.dim_nome AS D9N, d4.cat_id AS C9C, d4.cat_nome AS C9N,
         coalesce(nullif(d4.unidade, ''), nullif(d3.unidade, ''), nullif(d2.unidade, ''),
                  nullif(d1.unidade, ''), nullif(d0.unidade, ''),
                  CASE WHEN v.unidade NOT LIKE 'Vide categorias%' THEN v.unidade END) AS MN,
         coalesce(d4.nivel, d3.nivel, d2.nivel, d1.nivel, d0.nivel, 0) AS nivel
  FROM cubes c JOIN variables v USING (agregado_id) JOIN dims d USING (agregado_id)
  LEFT JOIN d0 USING (agregado_id) LEFT JOIN d1 USING (agregado_id)
  LEFT JOIN d2 USING (agregado_id) LEFT JOIN d3 USING (agregado_id)
  LEFT JOIN d4 USING (agregado_id)
  WHERE d.n_dimensoes > 0
)
"""
    wide = ", ".join(f"{p}{n}{s}" for n in range(5, 10) for p in "DC" for s in "CN")
    sql["flatten_cube"] = (
        with_parts(*ALL)
        + flat
        + f"""SELECT agregado_id, agregado, pesquisa, assunto, frequencia, url_agregado, D4C, D4N,
              {wide}, MN, CAST(nivel AS INT) AS nivel FROM flat WHERE n = 0 OR MN IS NOT NULL"""
    )
    sql["flatten_cube_units"] = (
        with_parts(*ALL)
        + flat
        + """SELECT agregado_id, D4C, MN, CAST(nivel AS INT) AS nivel, count(*) AS n_linhas
             FROM flat WHERE n = 0 OR MN IS NOT NULL GROUP BY ALL"""
    )

    columns = "agregado_id, nivel_territorial, chunk_seq, n_valores, url"
    sql["plan_full"] = chunk_sql(100_000) + f"SELECT {columns} FROM chunks"
    # A small limit and few places: single periods, places and variables, then categories.
    sql["plan_period_split"] = (
        chunk_sql(100_000, "split_p AND NOT split_l") + f"SELECT {columns} FROM chunks"
    )
    sql["plan_locality_batches"] = (
        chunk_sql(100_000, "split_l") + f"SELECT {columns} FROM chunks"
    )
    sql["plan_variable_split"] = chunk_sql(1_500, "split_v") + f"SELECT {columns} FROM chunks"
    sql["plan_class_split"] = chunk_sql(200, "n_c > 1") + f"SELECT {columns} FROM chunks"
    sql["plan_summary"] = (
        chunk_sql(100_000)
        + """SELECT agregado_id, nivel_territorial, count(*) AS n_requests,
             CAST(sum(n_valores) AS BIGINT) AS n_valores
             FROM chunks GROUP BY ROLLUP (agregado_id, nivel_territorial)"""
    )
    # Every place, period and variable of each request, counted; categories are never split at this limit.
    damage = {
        "gap": "(nivel = 'N1' AND agregado_id % 3 = 0 AND chunk_seq = 0)",
        "replaced": "(nivel = 'N6' AND agregado_id % 7 = 0 AND chunk_seq = 0)",
        "replacing": "(nivel = 'N6' AND agregado_id % 7 = 0 AND chunk_seq = 1)",
        "doubled": "(nivel = 'N3' AND agregado_id % 4 = 0 AND chunk_seq = 1)",
        "overlapping": "(nivel = 'N3' AND agregado_id % 5 = 0 AND chunk_seq = 0)",
        "boundless": "(nivel = 'N6' AND agregado_id % 11 = 0 AND chunk_seq = 0)",
    }
    whole_plan = "SELECT *, 4 AS vars FROM numbered"
    damaged_plan = f"""
      SELECT *, 4 AS vars FROM numbered WHERE NOT {damage['gap']} AND NOT {damage['replaced']}
      UNION ALL SELECT *, 4 FROM numbered WHERE {damage['replacing']} OR {damage['doubled']}
      UNION ALL SELECT *, 1 FROM numbered WHERE {damage['overlapping']}
      UNION ALL SELECT agregado_id, nivel, chunk_seq, NULL, NULL, 4 FROM numbered WHERE {damage['boundless']}"""
    for name, asked in (("plan_coverage", whole_plan), ("plan_coverage_damaged", damaged_plan)):
        sql[name] = (
            with_parts(*ALL, plan_parts(100_000))
            + f""", numbered AS (
              SELECT agregado_id, nivel, chunk_seq, CASE WHEN split_p THEN chunk_seq // n_b END AS p_i,
                     CASE WHEN split_l THEN chunk_seq % n_b END AS b_i
              FROM (SELECT *, unnest(range(CAST(n_p * n_b * n_v * n_c AS BIGINT))) AS chunk_seq FROM levels)
            ), asked AS ({asked}
            ), cells_asked AS (
              SELECT a.agregado_id, a.nivel, a.vars, p.ord AS p, o.ord AS o
              FROM asked a JOIN levels USING (agregado_id, nivel)
              JOIN periods p ON p.agregado_id = a.agregado_id AND (p_i IS NULL OR p.ord = p_i)
              JOIN localities o ON o.agregado_id = a.agregado_id AND o.nivel = a.nivel AND (b_i IS NULL OR o.ord // lote = b_i)
            ), counted AS (
              SELECT agregado_id, nivel, p, o, count(*) AS primeira, count(*) FILTER (vars = 4) AS outras
              FROM cells_asked GROUP BY ALL
            ), per_level AS (
              SELECT agregado_id, nivel, sum(primeira + 3 * outras) AS n, count(*) AS n_pares,
                     bool_and(primeira = 1 AND outras = 1) AS uma_vez
              FROM counted GROUP BY ALL
            ), requests AS (
              SELECT agregado_id, nivel, count(*) AS n_requests, max(vars * D
                * CASE WHEN p_i IS NULL THEN P ELSE 1 END * CASE WHEN b_i IS NULL THEN L ELSE least(lote, L - b_i * lote) END) AS maior
              FROM asked JOIN levels USING (agregado_id, nivel) GROUP BY ALL
            )
            SELECT l.agregado_id, l.nivel AS nivel_territorial, coalesce(n_requests, 0) AS n_requests,
                   CAST(total AS BIGINT) AS n_valores, CAST(coalesce(n, 0) * D AS BIGINT) AS celulas,
                   coalesce(uma_vez AND n_pares = P * L, total = 0) AS exato, coalesce(maior <= 100000, TRUE) AS cabe
            FROM levels l LEFT JOIN per_level USING (agregado_id, nivel) LEFT JOIN requests USING (agregado_id, nivel)"""
        )
    sql["plan_restricted"] = (
        chunk_sql(2_000, "nivel IN ('N3', 'N6') AND agregado_id NOT IN (SELECT agregado_id FROM cubes "
                  "WHERE pesquisa_id LIKE '%9')", restricted=True)
        + f"SELECT {columns} FROM chunks"
    )
    sql["selection_errors"] = (
        with_parts(CUBES)
        + """SELECT agregado_id, e.* FROM cubes, (VALUES
               ('variavel', NULL, '999', 'inexistente'),
               ('classificacao', '77', NULL, 'inexistente')) e(dim, class_id, id, motivo)
             WHERE pesquisa_id LIKE '%9'"""
    )
    sql["selection_specs"] = (
        with_parts(CUBES, CLASSES, SALES, CATEGORIES, PERIODS)
        + """SELECT agregado_id, 'classificacao' AS dim, CAST(class_id AS VARCHAR) AS class_id,
                    CAST(cat_id AS VARCHAR) AS id FROM categories
             UNION ALL SELECT agregado_id, 'periodo', NULL, per_id FROM periods"""
    )

    cell_parts = with_parts(*ALL, plan_parts(100_000), CELLS)
    sql["plan_cell_location"] = (
        chunk_sql(100_000)
        + f""", {CELLS}
        SELECT c.chunk_id, 4 * count(*) AS n_celulas, any_value(k.n_valores) AS n_valores
        FROM cells c JOIN chunks k USING (agregado_id, nivel_territorial, chunk_seq)
        GROUP BY c.chunk_id"""
    )
    statuses = (
        cell_parts
        + """, sent AS (SELECT DISTINCT agregado_id, nivel_territorial, chunk_seq, chunk_id FROM cells),
             payloads AS (
               SELECT *, CASE WHEN agregado_id % 3 = 0 AND nivel_territorial = 'N1' AND chunk_seq = 0
                 THEN 'Resposta inesperada em ' || chunk_id || ': {"status": 503, "message": "volte mais tarde"}'
                 END AS erro FROM sent
               UNION ALL SELECT *, NULL FROM sent WHERE chunk_seq = 1 AND agregado_id % 4 = 0
               UNION ALL SELECT *, 'Resposta inesperada em ' || chunk_id || ': [] e mais' FROM sent
                 WHERE nivel_territorial = 'N3' AND chunk_seq = 0
               UNION ALL SELECT NULL, NULL, NULL, 'cubo ' || agregado_id,
                 'Bloco desconhecido: cubo ' || agregado_id FROM cubes)
             """
    )
    sql["validate_payloads"] = statuses + (
        "SELECT agregado_id, nivel_territorial, erro, count(*) AS n_payloads FROM payloads GROUP BY ALL"
    )
    sql["rejected_payloads"] = statuses + "SELECT chunk_id, erro FROM payloads WHERE erro IS NOT NULL"
    sql["strip_headers"] = (
        cell_parts
        + """SELECT DISTINCT agregado_id, nivel_territorial, h.chave, h.texto
             FROM good_cells JOIN dims USING (agregado_id), (VALUES
               ('NC', 'Nível Territorial (Código)', 0), ('V', 'Valor', 0),
               ('D1C', 'Local (Código)', 0), ('D2C', 'Período (Código)', 0),
               ('D3C', 'Variável (Código)', 0), ('D4C', 'Classificação 1 (Código)', 1),
               ('D5C', 'Classificação 2 (Código)', 2), ('D6C', 'Classificação 3 (Código)', 3),
               ('D7C', 'Classificação 4 (Código)', 4), ('D8C', 'Classificação 5 (Código)', 5)
             ) h(chave, texto, minimo) WHERE n_classificacoes >= minimo"""
    )
    sql["merge_values"] = (
        cell_parts
        + """SELECT agregado_id, nivel_territorial, loc_id, per_id, var_id, categorias,
                    CAST(CAST(valor AS DECIMAL(28,2)) AS VARCHAR) AS valor FROM cell_values"""
    )
    by_level = (
        cell_parts
        + """SELECT agregado_id, nivel_territorial, count(*) AS n_valores,
                    CAST(CAST(sum(valor) AS DECIMAL(38,2)) AS VARCHAR) AS soma
             FROM cell_values GROUP BY ALL"""
    )
    sql["values_by_level"] = sql["stream_values"] = sql["payload_files"] = by_level
    progress = (
        statuses
        + """, chunk_states AS (
               SELECT agregado_id, nivel_territorial AS nivel, chunk_seq, bool_or(erro IS NULL) AS aceito
               FROM payloads WHERE chunk_seq IS NOT NULL GROUP BY ALL
             ), landed AS (
               SELECT agregado_id, nivel, count(*) FILTER (aceito) AS n, count(*) FILTER (NOT aceito) AS m
               FROM chunk_states GROUP BY ALL)
             SELECT agregado_id, nivel AS nivel_territorial,
                    CAST(n_p * n_b * n_v * n_c AS BIGINT) AS planejados, coalesce(n, 0) AS feitos,
                    coalesce(m, 0) AS rejeitados
             FROM levels LEFT JOIN landed USING (agregado_id, nivel)"""
    )
    sql["chunk_progress"] = sql["stream_progress"] = progress
    # The lines of each level as they are written, with their places.
    placed = """, lines AS (
          SELECT agregado_id, nivel_territorial, chunk_seq, loc_id, per_id, var_id, categorias, valor,
            '{"NC":"' || nivel_territorial || '","V":"' || CAST(valor AS DECIMAL(28,2)) || '","D1C":"' || loc_id
            || '","D2C":"' || per_id || '","D3C":"' || var_id || '"' || CASE WHEN categorias = '' THEN '' ELSE
               list_reduce([''] || list_transform(string_split(categorias, ','), lambda c, i: ',"D' || (i + 3) || 'C":"' || c || '"'),
                 lambda a, b: a || b) END || '}' AS linha
          FROM (SELECT * EXCLUDE (chunk_id), CAST(split_part(chunk_id, '-', 3) AS BIGINT) AS chunk_seq FROM cell_values)
        ), labels AS (
          SELECT DISTINCT agregado_id, nivel_territorial, '{"NC":"Nível Territorial (Código)","V":"Valor",'
            || '"D1C":"Local (Código)","D2C":"Período (Código)","D3C":"Variável (Código)"'
            || list_reduce([''] || list_transform(range(1, n_classificacoes + 1),
                 lambda i: ',"D' || (i + 3) || 'C":"Classificação ' || i || ' (Código)"'), lambda a, b: a || b) || '}' AS linha
          FROM lines JOIN dims USING (agregado_id)
        )"""
    sql["values_of_one_level"] = (
        cell_parts
        + placed
        + """SELECT agregado_id, row_number() OVER (PARTITION BY agregado_id ORDER BY chunk_seq, linha) - 1 AS posicao,
                    loc_id, per_id, var_id, categorias, CAST(CAST(valor AS DECIMAL(28,2)) AS VARCHAR) AS valor
             FROM lines WHERE nivel_territorial = 'N3'"""
    )
    sql["stream_repeated"] = (
        cell_parts
        + placed
        + """, bodies AS (
               SELECT agregado_id, nivel_territorial, chunk_seq, count(*) AS n, sum(valor) AS soma,
                 sum(CAST('1' || CAST(valor AS DECIMAL(28,2)) AS DECIMAL(28,2))) AS outra,
                 '[' || any_value(b.linha) || ',' || string_agg(l.linha, ',' ORDER BY l.linha) || ']' AS body
               FROM lines l JOIN labels b USING (agregado_id, nivel_territorial) GROUP BY ALL
             ), kept AS (
               SELECT *, CASE WHEN nivel_territorial = 'N3'
                   AND sha256(regexp_replace(body, '"V":"([0-9]+)', '"V":"1\\1', 'g')) < sha256(body) THEN outra ELSE soma END AS fica
               FROM bodies)
             SELECT agregado_id, nivel_territorial, CAST(sum(n) AS BIGINT) AS n_valores,
                    CAST(CAST(sum(fica) AS DECIMAL(38,2)) AS VARCHAR) AS soma FROM kept GROUP BY ALL"""
    )
    sql["manifest"] = (
        chunk_sql(100_000)
        + f""", {CELLS}
        {placed}, numbered AS (
          SELECT agregado_id, nivel_territorial, linha,
            row_number() OVER (PARTITION BY agregado_id, nivel_territorial ORDER BY chunk_seq, linha) AS posicao FROM lines
          UNION ALL SELECT agregado_id, nivel_territorial, linha, 0 FROM labels
        ), blocks AS (
          SELECT agregado_id, nivel_territorial, posicao // 1000 AS bloco, count(*) AS n,
            string_agg(linha || chr(10), '' ORDER BY posicao) AS texto FROM numbered GROUP BY ALL
        ), groups_of_blocks AS (
          SELECT agregado_id, nivel_territorial, bloco // 1000 AS grupo, sum(n) AS n, sum(strlen(texto)) AS bytes,
            sha256(string_agg(sha256(texto), '' ORDER BY bloco)) AS sha FROM blocks GROUP BY ALL
        ), written AS (
          SELECT agregado_id, nivel_territorial, sum(n) AS n_linhas, CAST(sum(bytes) AS BIGINT) AS size_bytes,
            sha256(string_agg(sha, '' ORDER BY grupo)) AS sha256 FROM groups_of_blocks GROUP BY ALL
        ), planned AS (SELECT agregado_id, nivel_territorial, min_by(url, chunk_seq) AS url,
                              CAST(count(*) AS VARCHAR) AS n_requests FROM chunks GROUP BY ALL)
        SELECT 'estrela' AS source_id, agregado_id || ':' || nivel_territorial AS dataset_id, url, n_requests,
               CAST(n_linhas AS VARCHAR) AS n_linhas, sha256, size_bytes,
               'agregados/' || agregado_id || '/dados_' || nivel_territorial || '.ndjson' AS path
        FROM written JOIN planned USING (agregado_id, nivel_territorial)"""
    )

    sql["snapshot_summary"] = sql["cube_summary"]
    sql["documents_cube_summary"] = f"SELECT * EXCLUDE (pesquisa_id) FROM ({sql['cube_summary']})"
    sql["documents_plan"] = sql["plan_full"]
    sql["documents_localities"] = (
        with_parts(CUBES, SALES, PLACES) + "SELECT agregado_id, nivel, loc_id, nome, ord FROM localities"
    )
    sql["documents_unreadable"] = (
        with_parts(CUBES)
        + """SELECT '/agregados/' || agregado_id || '/localidades_N9_0.json' AS caminho, agregado_id
             FROM cubes WHERE agregado_id % 10 = 0"""
    )
    sql["assemble_cube"] = (
        with_parts(*ALL)
        + parsed
        + """SELECT c.agregado_id AS id, coalesce(n_periodos, 0) AS n_periodos,
                    CAST(4 AS BIGINT) AS n_variaveis, n_classificacoes,
                    coalesce((SELECT CAST(sum(n_localidades) AS BIGINT) FROM level_counts l
                              WHERE l.agregado_id = c.agregado_id), 0) AS n_localidades,
                    (SELECT min(data_inicio) FROM parsed p WHERE p.agregado_id = c.agregado_id) AS inicio,
                    (SELECT 'Cliente ' || max(lugar) FROM places p
                     WHERE p.agregado_id = c.agregado_id AND nivel = 'N6') AS ultima,
                    'N1,N3,N7,N6' AS niveis
             FROM cubes c JOIN dims USING (agregado_id) LEFT JOIN period_counts USING (agregado_id)"""
    )
    sql["assembled_localities"] = (
        with_parts(CUBES, SALES, PLACES)
        + """SELECT agregado_id, CAST(CASE nivel WHEN 'N1' THEN 0 WHEN 'N3' THEN 1 ELSE 3 END AS INT)
                    AS nivel_ord, ord, nivel, loc_id, nome FROM localities"""
    )
    sql["snapshot_roundtrip"] = (
        with_parts(CUBES, PERIODS) + parsed + f"SELECT {fields} FROM parsed"
    )
    sql["metadata_urls"] = (
        with_parts(CUBES)
        + """, bases AS (SELECT agregado_id,
               'https://api.example.org/agregados/' || agregado_id || '/' AS base FROM cubes)
             SELECT agregado_id, NULL AS nivel, tipo, base || tipo AS url
             FROM bases, (VALUES ('metadados'), ('periodos')) t(tipo)
             UNION ALL SELECT agregado_id, nivel, 'localidades', base || 'localidades/' || nivel
             FROM bases, (VALUES ('N1'), ('N3'), ('N6'), ('N7')) n(nivel)"""
    )
    sql["collection_listing"] = (
        with_parts(CUBES, VARIABLES, CLASSES, PERIODS)
        + """SELECT 'A' AS acervo, assunto AS id, assunto AS nome, count(*) AS n FROM cubes GROUP BY ALL
             UNION ALL SELECT 'C', CAST(class_id AS VARCHAR), nome, count(*) FROM classes GROUP BY ALL
             UNION ALL SELECT 'N', nivel, NULL, count(*)
               FROM cubes, (VALUES ('N1'), ('N3'), ('N6'), ('N7')) n(nivel) GROUP BY ALL
             UNION ALL SELECT 'P', per_id, NULL, count(*) FROM periods GROUP BY ALL
             UNION ALL SELECT 'E', frequencia, NULL, count(*) FROM cubes GROUP BY ALL
             UNION ALL SELECT 'V', CAST(var_id AS VARCHAR), nome, count(*) FROM variables GROUP BY ALL"""
    )

    sql["resolve_periods"] = (
        with_parts(CUBES, PERIODS)
        + """, numbered AS (SELECT agregado_id, per_id, ord, count(*) OVER (PARTITION BY agregado_id) AS n FROM periods),
             asked AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey + 1 AS BIGINT) AS agregado_id,
                              strftime(l_shipdate, '%Y%m') AS mes FROM lineitem),
             meant AS (
               SELECT a.*, per_id, ord FROM asked a LEFT JOIN numbered p ON p.agregado_id = a.agregado_id
                 AND CASE l_linenumber WHEN 1 THEN TRUE WHEN 2 THEN ord >= n - 12 ELSE per_id = mes END)
             SELECT l_orderkey, l_linenumber, l_partkey, count(per_id) AS n_periodos, min_by(per_id, ord) AS primeiro,
                    max_by(per_id, ord) AS ultimo,
                    CASE WHEN count(per_id) > 0 OR l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN 'last%2012'
                         ELSE mes || ',' || mes || '-' || mes END AS sem_periodo
             FROM meant GROUP BY l_orderkey, l_linenumber, l_partkey, mes"""
    )
    sql["documents_surveys"] = sql["flatten_surveys"]
    sql["collection_paths"] = (
        with_parts(CUBES, VARIABLES, CLASSES, PERIODS)
        + parsed
        + f""", items AS (
             SELECT 'A' AS acervo, '$.id' AS caminho, 'STRING' AS tipo, assunto AS valor FROM cubes
             UNION ALL SELECT 'A', '$.nome', 'STRING', assunto FROM cubes
             UNION ALL SELECT 'C', '$.id', 'BIGINT', CAST(class_id AS VARCHAR) FROM classes
             UNION ALL SELECT 'C', '$.nome', 'STRING', nome FROM classes
             UNION ALL SELECT 'N', '$.id', 'STRING', nivel FROM cubes, (VALUES ('N1'), ('N3'), ('N6'), ('N7')) n(nivel)
             UNION ALL SELECT 'N', '$.detalhe.grupo', 'STRING', grupo
               FROM cubes, (VALUES ('administrativo'), ('administrativo'), ('especial'), ('ibge')) n(grupo)
             UNION ALL SELECT 'P', '$.id', 'STRING', per_id FROM periods
             UNION ALL SELECT 'P', '$.literals[]', 'STRING', unnest([{literal}, per_id]) FROM periods
             UNION ALL SELECT 'E', '$.id', 'STRING', frequencia FROM cubes
             UNION ALL SELECT 'V', '$.id', 'BIGINT', CAST(var_id AS VARCHAR) FROM variables
             UNION ALL SELECT 'V', '$.nome', 'STRING', nome FROM variables
             UNION ALL SELECT 'V', '$.unidade', 'STRING', unidade FROM variables)
           SELECT acervo, caminho, tipo, count(*) AS n, min(valor) AS menor, max(valor) AS maior FROM items GROUP BY ALL"""
    )
    sql.update(_request_oracles())
    return sql


# The parts of the request of a line item, as texts: raw segment and parsed value.
REQUEST_PARTS = """
WITH requests AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    '/t/' || l_suppkey AS t, CAST(l_suppkey AS VARCHAR) AS t_valor,
    CASE WHEN l_returnflag = 'N' THEN '/n6/' || l_partkey || ',' || l_orderkey || '/n10/all'
         ELSE '/n3/' || l_linenumber END AS n,
    CASE WHEN l_returnflag = 'N' THEN '6=' || l_partkey || ',' || l_orderkey || ';10=all'
         ELSE '3=' || l_linenumber END AS n_valor,
    CASE WHEN l_linestatus = 'F' THEN 'all' ELSE l_linenumber || ',33' END AS v_valor,
    CASE WHEN l_linenumber = 1 THEN 'all' WHEN l_linenumber = 2 THEN 'last%2012'
         ELSE strftime(l_shipdate, '%Y%m') || ',' || strftime(l_shipdate, '%Y%m') || '-'
              || strftime(l_shipdate, '%Y%m') END AS p_valor,
    CASE WHEN l_returnflag = 'R' THEN ''
         ELSE '/c2/' || l_linenumber || ',' || l_partkey || '/c81/all' END AS c,
    CASE WHEN l_returnflag = 'R' THEN ''
         ELSE '2=' || l_linenumber || ',' || l_partkey || ';81=all' END AS c_valor,
    CASE WHEN l_linestatus = 'F' THEN 'y' ELSE 'n' END AS h,
    CASE l_returnflag WHEN 'A' THEN 'a' WHEN 'N' THEN 'n' ELSE 'u' END AS f_valor,
    CASE l_linenumber WHEN 3 THEN '2' WHEN 4 THEN 'v' || l_partkey || '%205,v33%200'
         WHEN 5 THEN 'v33%20m' WHEN 6 THEN 's' ELSE 'm' END AS d,
    CASE l_linenumber WHEN 3 THEN '=2'
         WHEN 4 THEN CASE WHEN l_partkey = 33 THEN '33=0' ELSE l_partkey || '=5,33=0' END
         WHEN 5 THEN '33=m' WHEN 6 THEN '=s' ELSE '=m' END AS d_valor
  FROM lineitem
)
"""


def _request_oracles() -> dict[str, str]:
    key = "l_orderkey, l_linenumber, l_partkey"
    url = (
        "t || n || '/v/' || v_valor || '/p/' || {} || c || '/h/' || h || '/f/' || f_valor"
        " || '/d/' || d"
    )

    def part(raw: str, value: str, missing: str = "") -> str:
        return (
            REQUEST_PARTS
            + f"""SELECT {key}, {raw} AS bruto, {value} AS valor FROM requests
                  UNION ALL SELECT -page_id - 1, 0, 0, '', '{missing}' FROM pages"""
        )

    def whole(n, n_valor, c, c_valor, d, d_valor):
        return REQUEST_PARTS + f"""
            SELECT {key}, t || '|' || {n} || '|' || {c} || '|/v/' || v_valor || '|/h/' || h || '|/f/' || f_valor
                   || '|' || {d} || '|/p/' || p_valor AS partes,
                   t_valor AS agregado, {n_valor} AS territorios, {c_valor} AS classificacoes,
                   v_valor AS variaveis, p_valor AS periodos, h = 'y' AS cabecalho, f_valor AS formato,
                   {d_valor} AS decimais FROM requests
            UNION ALL SELECT -page_id - 1, 0, 0, '|||||||', '', '', '', '', '', TRUE, 'a', '' FROM pages"""

    # The older reading: levels of one digit, the last of several ids twice, precisions of
    # variables are numbers, and no number stands for all.
    older = whole(
        "CASE WHEN n LIKE '/n6/%' THEN '/n6/' || l_partkey || ',' || l_orderkey || ',' || l_orderkey ELSE n END",
        "CASE WHEN n LIKE '/n6/%' THEN '6=' || l_partkey || ',' || l_orderkey || ',' || l_orderkey ELSE n_valor END",
        "CASE WHEN c = '' THEN '' ELSE '/c2/' || l_linenumber || ',' || l_partkey || ',' || l_partkey || '/c81/all' END",
        "CASE WHEN c = '' THEN '' ELSE '2=' || l_linenumber || ',' || l_partkey || ',' || l_partkey || ';81=all' END",
        "CASE WHEN l_linenumber IN (3, 5) THEN '' ELSE '/d/' || d END",
        "CASE WHEN l_linenumber IN (3, 5) THEN '' ELSE d_valor END",
    )
    return {
        "parse_urls_whole": whole("n", "n_valor", "c", "c_valor", "'/d/' || d", "d_valor"),
        "parse_urls_compat": older,
        "request_domains": f"""
            SELECT {key}, CASE WHEN l_returnflag = 'R' AND l_quantity >= 21 THEN 'formato,decimais'
                WHEN l_returnflag = 'R' THEN 'formato' WHEN l_quantity >= 21 THEN 'decimais' ELSE '' END
                AS desconhecidos FROM lineitem""",
        "render_url": REQUEST_PARTS + f"SELECT {key}, {url.format('p_valor')} AS url FROM requests",
        "render_period_url": REQUEST_PARTS
        + f"SELECT {key}, {url.format(repr('200101'))} AS url FROM requests",
        "parse_url_aggregate": part("t", "t_valor"),
        "parse_url_territories": part("n", "n_valor"),
        "parse_url_periods": part("'/p/' || p_valor", "p_valor"),
        "parse_url_variables": part("'/v/' || v_valor", "v_valor"),
        "parse_url_classes": part("c", "c_valor"),
        "parse_url_header": part("'/h/' || h", "CASE h WHEN 'y' THEN 'true' ELSE 'false' END", "true"),
        "parse_url_format": part("'/f/' || f_valor", "f_valor", "a"),
        "parse_url_decimals": part("'/d/' || d", "d_valor"),
        # A variable named twice in the precisions counts once, with its last precision.
        "normalise_requests": REQUEST_PARTS.replace(
            "WHEN 4 THEN 'v' ||", "WHEN 4 THEN CASE WHEN l_partkey = 33 THEN '' ELSE 'v' ||"
        ).replace("'%205,v33%200'", "'%205,' END || 'v33%200'")
        + f"""SELECT 'https://api.example.org/values' || {url.format('p_valor')} AS url,
                     count(*) AS n_pedidos FROM requests GROUP BY ALL""",
    }


PERIOD_QUERIES = {
    "parse_periods_mensal": "mensal",
    "parse_periods_trimestral": "trimestral",
    "parse_periods_movel": "trimestre_movel",
    "parse_periods_semestral": "semestral",
    "parse_periods_anual": "anual",
    "parse_periods_plurianual": "plurianual",
    "parse_periods_unrecognised": "nao_reconhecida",
}


def oracle_sql() -> dict[str, str]:
    return _oracles()
