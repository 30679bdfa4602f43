"""SQL counterparts of the registered queries, for DuckDB over the same Parquet tables.

They share no code with the Spark side. Money stays in whole cents and every rounding is done on
whole numbers (``half_up``), so an expected value is exact and not the result of a second float path.
"""

from __future__ import annotations

from .feeds import PRIORITIES, PRODUCTS, SEGMENTS_IN_USE

# Fixed values, written out here apart from the lists that the Spark side reads.
MONTH_NAMES = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]
UNKNOWN_REGION = "DESCONHECIDO"
AGE_BANDS = [(3, "Nova (0-3)"), (6, "Jovem (4-6)"), (9, "Madura (7-9)"), (14, "Antiga (10-14)")]
AGE_BAND_ABOVE = "Obsoleta (15+)"
AGE_YEARS = [(3, "0-3 anos"), (6, "4-6 anos"), (9, "7-9 anos"), (14, "10-14 anos")]
AGE_YEARS_ABOVE = "15+ anos"
ACTIONS = {
    "custo_por_km_CRITICO": "Substituir veículo ou revisar operação imediatamente",
    "custo_por_km_ATENCAO": "Agendar revisão e monitorar custo semanalmente",
    "margem_operacional_CRITICO": "Rever rota e composição de custos - operação deficitária",
    "margem_operacional_ATENCAO": "Otimizar custos operacionais e negociar fornecedores",
    "disponibilidade_pct_CRITICO": "Frota com baixa disponibilidade - ampliar reserva ou terceirizar",
    "disponibilidade_pct_ATENCAO": "Intensificar manutenção preventiva",
    "km_por_litro_real_CRITICO": "Consumo anômalo - inspecionar motor e pneus imediatamente",
    "km_por_litro_real_ATENCAO": "Monitorar eficiência - verificar calibragem e hábitos de condução",
}
DEFAULT_ACTION = "Manter monitoramento padrão"
AGE_ADVICE = [
    (0, 3, "Manutenção preventiva padrão - veículo no auge"),
    (4, 6, "Acompanhar custo de manutenção - planejar reserva"),
    (7, 9, "Planejar substituição - custo tende a subir"),
    (10, 14, "Avaliar substituição imediata - custo elevado de manutenção"),
    (15, 99, "Substituir obrigatoriamente - veículo obsoleto e ineficiente"),
]
DEFAULT_ADVICE = "Verificar estado geral do veículo"
DECISIONS = ["INTERVENCAO IMEDIATA", "MONITORAR E PLANEJAR", "OPERACAO NORMAL"]
INDICATORS = [("IPCA", "7060", "Indice Nacional de Precos ao Consumidor Amplo"), ("PIB", "6784", "Produto Interno Bruto a precos correntes"),
              ("SALARIO", "5938", "Rendimento medio mensal"), ("POPULACAO", "6579", "Projecao da populacao")]

# --- exact rounding ---------------------------------------------------------------


def half_up(num: str, den: str) -> str:
    """Whole-number quotient rounded half away from zero; ``den`` is positive or NULL."""
    return f"(CASE WHEN ({num}) < 0 THEN -1 ELSE 1 END * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def half_even(num: str, den: str) -> str:
    """Whole-number quotient of non-negative numbers rounded half to even."""
    up = f"2 * (({num}) % ({den})) > ({den}) OR (2 * (({num}) % ({den})) = ({den}) AND (({num}) // ({den})) % 2 = 1)"
    return f"((({num}) // ({den})) + CASE WHEN {up} THEN 1 ELSE 0 END)"


def scaled(expr: str, digits: int) -> str:
    """A whole number of 10^-digits units as a double."""
    return f"CAST({expr} AS DOUBLE) / {10 ** digits}e0"


def quotient(num: str, den: str, digits: int) -> str:
    """num / den rounded half up to ``digits``; both are whole numbers of the same unit."""
    return scaled(half_up(f"({num}) * {10 ** digits}", den), digits)


def avg(expr: str, unit: int, digits: int) -> str:
    """Mean of whole numbers of 10^-unit, rounded half up to ``digits``."""
    total, n = f"sum(({expr})::HUGEINT)", f"nullif(count({expr}), 0)"
    if digits >= unit:
        return scaled(half_up(f"{total} * {10 ** (digits - unit)}", n), digits)
    return scaled(half_up(total, f"({n}) * {10 ** (unit - digits)}"), digits)


def money(expr: str) -> str:
    return f"CAST(sum({expr}) AS DOUBLE) / 100e0"


def whole(expr: str) -> str:
    return f"CAST(sum({expr}) AS BIGINT)"


def r(expr: str, digits: int) -> str:
    """Round a double half up by floor."""
    return f"floor(({expr}) * 1e{digits} + 0.5e0) / 1e{digits}"


# --- the star ---------------------------------------------------------------------

STATE = "CAST((({k}) + ({k}) // 25) % 25 AS INTEGER)"


def typed(k: str, truck: str, sedan: str, pickup: str) -> str:
    return f"CASE WHEN {k} % 5 = 3 THEN {sedan} WHEN {k} % 5 = 4 THEN {pickup} ELSE {truck} END"


STAR = f"""
base AS (
  SELECT l_suppkey AS k, {STATE.format(k='l_suppkey')} AS uf,
         CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes,
         CAST(1995 - l_suppkey % 15 AS INTEGER) AS fab,
         (CAST(floor(l_quantity) AS BIGINT) - 1) * 100 AS km,
         CAST(floor(l_discount * 100 + 0.5e0) AS BIGINT) AS d,
         CAST(floor(l_tax * 100 + 0.5e0) AS BIGINT) AS t,
         l_linenumber AS n
  FROM lineitem),
fuel AS (
  SELECT *, CAST(ano - fab AS INTEGER) AS idade, 520 + 19 * d AS preco,
         {half_up('km * 1000000', "((" + typed('k', '35', '120', '85') + ") * (1000 - 60 * (k % 7) - 5 * t))")} AS litros
  FROM base),
parts AS (
  SELECT *, {half_up('litros * preco', '100')} AS comb,
         {half_up('km * (15 + 3 * idade) * (' + typed('k', '10', '2', '15') + ')', '10')} AS man,
         CASE WHEN mes = 1 THEN km * 10 ELSE 0 END AS ipva,
         {half_up('km * (700 - 30 * idade + 5 * d) * (' + typed('k', '10', '13', '10') + ')', '100')} AS dep,
         km * (250 + 150 * (k % 4) + 10 * t) AS rec,
         990 - 32 * (k % 9) - 2 * t AS disp, n * 8 AS viagens
  FROM fuel),
costs AS (SELECT *, {half_up('man * 4', '10')} AS seg FROM parts),
totals AS (SELECT *, comb + man + seg + ipva + dep AS total FROM costs),
f AS (
  SELECT *, CAST(ano * 100 + mes AS INTEGER) AS sk_tempo,
         CASE WHEN km > 0 THEN {half_up('total * 100', 'km')} ELSE 0 END AS cpk,
         CASE WHEN rec > 0 THEN {half_up('(rec - total) * 10000', 'rec')} ELSE 0 END AS margem,
         CASE WHEN litros > 0 THEN {half_up('km * 10000', 'litros')} ELSE 0 END AS kml
  FROM totals),
v AS (
  SELECT s_suppkey AS sk, 'V' || CAST(s_suppkey AS VARCHAR) AS id_veiculo,
         {typed('s_suppkey', "'Caminhao'", "'Carro Sedan'", "'Pickup'")} AS tipo_veiculo,
         'Marca ' || CAST(s_suppkey % 6 AS VARCHAR) AS marca,
         CAST(1995 - s_suppkey % 15 AS INTEGER) AS ano_fabricacao,
         {typed('s_suppkey', "'Diesel'", "'Flex'", "'Diesel'")} AS combustivel,
         CAST((s_suppkey % 500) * 700 AS INTEGER) AS km_atual,
         (['Ativo', 'Em Manutencao', 'Disponivel', 'Inativo'])[1 + s_suppkey % 4] AS status,
         {typed('s_suppkey', '350', '1200', '850')} AS esperado,
         s_suppkey % 30 AS carga
  FROM supplier),
e AS (
  SELECT CAST(n_nationkey AS INTEGER) AS sk, n_name AS sigla_estado, r_name AS regiao
  FROM nation JOIN region ON n_regionkey = r_regionkey)
"""

MONTHS = "[" + ", ".join(f"'{m}'" for m in MONTH_NAMES) + "]"


def over_star(select: str) -> str:
    return f"WITH {STAR}\n{select}"


F_E = "f JOIN e ON f.uf = e.sk"
F_V = "f JOIN v ON f.k = v.sk"
F_V_E = "f JOIN v ON f.k = v.sk JOIN e ON f.uf = e.sk"
KM = "nullif(km, 0)"


def per_km(cents: str) -> str:
    """Row cost per km in units of 10^-13."""
    return half_up(f"({cents})::HUGEINT * {10 ** 11}", KM)


def band(bounds, above: str) -> str:
    whens = " ".join(f"WHEN idade <= {b} THEN '{label}'" for b, label in bounds)
    return f"CASE {whens} ELSE '{above}' END"


def fact_columns() -> str:
    cents = {
        "litros_consumidos": "litros", "preco_combustivel": "preco", "custo_combustivel": "comb",
        "custo_manutencao": "man", "custo_seguro": "seg", "custo_ipva": "ipva",
        "custo_depreciacao": "dep", "custo_total": "total", "receita_estimada": "rec",
    }
    return ", ".join(
        ["CAST(km AS INTEGER) AS km_rodado"]
        + [f"CAST({c} AS DOUBLE) / 100e0 AS {name}" for name, c in cents.items()]
        + [
            "CAST(viagens AS INTEGER) AS viagens_realizadas",
            "CAST(disp AS DOUBLE) / 10e0 AS disponibilidade_pct",
            "CAST(cpk AS DOUBLE) / 10000e0 AS custo_por_km",
            "CAST(margem AS DOUBLE) / 10000e0 AS margem_operacional",
            "CAST(kml AS DOUBLE) / 100e0 AS km_por_litro_real",
            "idade AS idade_veiculo",
        ]
    )


ORACLE: dict[str, str] = {}

# --- SQL analytics ----------------------------------------------------------------

VEHICLES = "count(DISTINCT k) AS total_veiculos"
PROFIT = "CAST(sum(rec) - sum(total) AS DOUBLE) / 100e0"

ORACLE["vw_resumo_mensal"] = over_star(f"""
SELECT ano, mes, {MONTHS}[mes] AS nome_mes, {VEHICLES}, {whole('km')} AS total_km_rodado,
       {money('comb')} AS total_custo_combustivel, {money('man')} AS total_custo_manutencao,
       {money('total')} AS total_custo, {money('rec')} AS total_receita, {whole('viagens')} AS total_viagens,
       {avg('cpk', 4, 4)} AS custo_medio_por_km, {avg('margem', 4, 4)} AS margem_media,
       {avg('disp', 1, 1)} AS disponibilidade_media, {avg('kml', 2, 2)} AS consumo_medio_real,
       {PROFIT} AS lucro_operacional
FROM f GROUP BY ano, mes""")

ORACLE["vw_kpi_estado"] = over_star(f"""
SELECT sigla_estado, regiao, {VEHICLES}, {whole('km')} AS total_km_rodado, {money('total')} AS total_custo,
       {money('rec')} AS total_receita, {avg('cpk', 4, 4)} AS custo_medio_por_km,
       {avg('margem', 4, 4)} AS margem_media, {avg('disp', 1, 1)} AS disponibilidade_media,
       {avg('kml', 2, 2)} AS consumo_medio_km_l, {PROFIT} AS lucro_operacional
FROM {F_E} GROUP BY sigla_estado, regiao""")
ORACLE["sink_star_full_refresh"] = ORACLE["dash_g7"] = ORACLE["vw_kpi_estado"]

ORACLE["vw_kpi_tipo_veiculo"] = over_star(f"""
SELECT tipo_veiculo, combustivel, {VEHICLES}, {whole('km')} AS total_km_rodado, {money('total')} AS total_custo,
       {money('rec')} AS total_receita, {avg('cpk', 4, 4)} AS custo_medio_por_km,
       {avg(per_km('comb'), 13, 4)} AS custo_combustivel_por_km,
       {avg(per_km('man'), 13, 4)} AS custo_manutencao_por_km,
       {avg('margem', 4, 4)} AS margem_media, {avg('kml', 2, 2)} AS consumo_medio_real,
       {avg('disp', 1, 1)} AS disponibilidade_media
FROM {F_V} GROUP BY tipo_veiculo, combustivel""")

HIGH_COST = f"""
SELECT id_veiculo, tipo_veiculo, marca, ano_fabricacao, status, sigla_estado,
       {avg('cpk', 4, 4)} AS custo_medio_por_km, {avg('margem', 4, 4)} AS margem_media,
       {avg('disp', 1, 1)} AS disponibilidade_media, {money('total')} AS custo_total_periodo,
       {whole('km')} AS km_total_periodo, idade AS idade_veiculo
FROM {F_V_E}
GROUP BY id_veiculo, tipo_veiculo, marca, ano_fabricacao, status, sigla_estado, idade
HAVING sum(cpk) > 15000 * count(cpk)"""
ORACLE["vw_veiculos_alto_custo"] = over_star(HIGH_COST)
ORACLE["dash_alto_custo_count"] = over_star(f"SELECT count(*) AS veiculos_criticos FROM ({HIGH_COST})")
ORACLE["dash_g11"] = over_star(f"""
SELECT *, id_veiculo || ' - ' || tipo_veiculo AS label FROM ({HIGH_COST}
ORDER BY sum(cpk) / count(cpk) DESC, id_veiculo, sigla_estado, idade LIMIT 20)""")

ORACLE["vw_impacto_combustivel"] = over_star(f"""
SELECT ano, mes, sigla_estado, tipo_veiculo, {avg('preco', 2, 2)} AS preco_medio_combustivel,
       {money('litros')} AS total_litros, {money('comb')} AS total_custo_combustivel,
       {money('total')} AS total_custo,
       {quotient('sum(comb) * 100', 'nullif(sum(total), 0)', 2)} AS pct_combustivel_no_custo
FROM {F_V_E} GROUP BY ano, mes, sigla_estado, tipo_veiculo""")

ORACLE["vw_eficiencia_idade"] = over_star(f"""
SELECT {band(AGE_BANDS, AGE_BAND_ABOVE)} AS faixa_idade, {VEHICLES},
       {avg('cpk', 4, 4)} AS custo_medio_por_km, {avg('man', 2, 2)} AS custo_medio_manutencao,
       {avg('disp', 1, 1)} AS disponibilidade_media, {avg('kml', 2, 2)} AS consumo_medio_real
FROM f GROUP BY 1""")
ORACLE["dash_g9"] = ORACLE["vw_eficiencia_idade"]

RANKING = f"""
SELECT id_veiculo, tipo_veiculo, marca, sigla_estado, {avg('margem', 4, 4)} AS margem_media,
       {avg('cpk', 4, 4)} AS custo_por_km, {money('rec')} AS receita_total, {money('total')} AS custo_total
FROM {F_V_E} GROUP BY id_veiculo, tipo_veiculo, marca, sigla_estado"""
ORACLE["vw_ranking_margem"] = over_star(RANKING)
ORACLE["dash_g8"] = over_star(f"""
SELECT *, CAST({half_up('CAST(round(margem_media * 1e4) AS BIGINT)', '10')} AS DOUBLE) / 10e0 AS margem_pct,
       id_veiculo || ' - ' || tipo_veiculo AS label
FROM (SELECT * FROM ({RANKING}) ORDER BY margem_media, id_veiculo, sigla_estado LIMIT 20)""")

ORACLE["kpi_custo_por_km"] = over_star(f"""
SELECT 'Custo por Km' AS kpi, tipo_veiculo, sigla_estado, ano, mes, {avg('cpk', 4, 4)} AS valor,
       {avg(per_km('comb'), 13, 4)} AS componente_combustivel,
       {avg(per_km('man'), 13, 4)} AS componente_manutencao,
       {avg(per_km('seg + dep'), 13, 4)} AS componente_fixo
FROM {F_V_E} GROUP BY tipo_veiculo, sigla_estado, ano, mes""")

ORACLE["kpi_consumo_medio"] = over_star(f"""
SELECT 'Consumo Medio' AS kpi, tipo_veiculo, combustivel, {avg('kml', 2, 2)} AS km_por_litro,
       {avg('km', 0, 0)} AS km_medio_mensal, {avg('litros', 2, 1)} AS litros_medio_mensal
FROM {F_V} GROUP BY tipo_veiculo, combustivel""")

ORACLE["kpi_utilizacao"] = over_star(f"""
SELECT 'Utilizacao Frota' AS kpi, sigla_estado, ano, mes, count(DISTINCT k) AS veiculos_ativos,
       {avg('disp', 1, 1)} AS disponibilidade_media, {whole('viagens')} AS total_viagens,
       {avg('km', 0, 0)} AS km_medio_por_veiculo,
       {scaled(half_up('sum(rec)', 'count(DISTINCT k)'), 2)} AS receita_por_veiculo
FROM {F_E} GROUP BY sigla_estado, ano, mes""")

ORACLE["kpi_composicao_custos"] = over_star(f"""
SELECT 'Composicao Custos' AS kpi, ano, {money('comb')} AS total_combustivel, {money('man')} AS total_manutencao,
       {money('seg')} AS total_seguro, {money('ipva')} AS total_ipva, {money('dep')} AS total_depreciacao,
       {money('total')} AS total_geral,
       {quotient('sum(comb) * 100', 'nullif(sum(total), 0)', 1)} AS pct_combustivel,
       {quotient('sum(man) * 100', 'nullif(sum(total), 0)', 1)} AS pct_manutencao
FROM f GROUP BY ano""")

ORACLE["kpi_rentabilidade"] = over_star(f"""
SELECT 'Rentabilidade' AS kpi, tipo_veiculo, {money('rec')} AS receita_total, {money('total')} AS custo_total,
       {PROFIT} AS lucro, {avg('margem', 2, 1)} AS margem_pct
FROM {F_V} GROUP BY tipo_veiculo""")


def price_impact(partition: str) -> str:
    window = f"OVER (PARTITION BY {partition} ORDER BY ano, mes, sigla_estado)"
    share = half_up(f"comb::HUGEINT * {10 ** 15}", "nullif(total, 0)")
    return over_star(f""", g AS (
  SELECT ano, mes, tipo_veiculo, sigla_estado, sum(preco) AS s, count(preco)::HUGEINT AS n,
         {avg('preco', 2, 2)} AS preco_combustivel, {avg('cpk', 4, 4)} AS custo_por_km,
         {avg('comb', 2, 2)} AS custo_combustivel, {avg(share, 13, 1)} AS impacto_pct
  FROM {F_V_E} GROUP BY ano, mes, tipo_veiculo, sigla_estado),
h AS (SELECT *, lag(s) {window} AS s0, lag(n) {window} AS n0 FROM g)
SELECT ano, mes, tipo_veiculo, sigla_estado, preco_combustivel, custo_por_km, custo_combustivel, impacto_pct,
       {scaled(half_up('s0', 'n0'), 2)} AS preco_anterior,
       {quotient('(s * n0 - s0 * n) * 100', 'nullif(s0 * n, 0)', 1)} AS variacao_preco_pct
FROM h""").replace(")\n, g AS", "),\ng AS", 1)


ORACLE["diag_impacto_preco"] = price_impact("tipo_veiculo")
ORACLE["diag_impacto_preco_uf"] = price_impact("tipo_veiculo, sigla_estado")

DEVIATION = quotient("(esperado * count(kml) - sum(kml)) * 100", "nullif(esperado * count(kml), 0)", 1)

ORACLE["diag_ineficiencia"] = over_star(f"""
SELECT id_veiculo, tipo_veiculo, marca, ano_fabricacao, status, sigla_estado, idade AS idade_veiculo,
       {avg('cpk', 4, 4)} AS custo_por_km, {avg('comb', 2, 2)} AS custo_combustivel_medio,
       {avg('man', 2, 2)} AS custo_manutencao_medio, {avg('disp', 1, 1)} AS disponibilidade,
       {avg('kml', 2, 2)} AS consumo_real, CAST(esperado AS DOUBLE) / 100e0 AS consumo_esperado,
       {DEVIATION} AS desvio_consumo_pct,
       CASE WHEN sum(cpk) > 25000 * count(cpk) THEN 'CRITICO' WHEN sum(cpk) > 18000 * count(cpk) THEN 'ATENCAO'
            ELSE 'NORMAL' END AS classificacao_custo
FROM {F_V_E}
GROUP BY id_veiculo, tipo_veiculo, marca, ano_fabricacao, status, sigla_estado, idade, esperado
HAVING sum(cpk) > 10000 * count(cpk)""")

ORACLE["diag_causa_raiz"] = over_star(f""", u AS (
  SELECT tipo_veiculo, idade, cpk, {per_km('comb')} AS c, {per_km('man')} AS m, {per_km('seg')} AS s,
         {per_km('dep')} AS d0 FROM {F_V})
SELECT tipo_veiculo, idade AS idade_veiculo, {band(AGE_YEARS, AGE_YEARS_ABOVE)} AS faixa_idade,
       count(*) AS num_registros, {avg('cpk', 4, 4)} AS custo_por_km, {avg('c', 13, 4)} AS custo_comb_km,
       {avg('m', 13, 4)} AS custo_man_km, {avg('s', 13, 4)} AS custo_seg_km, {avg('d0', 13, 4)} AS custo_dep_km,
       CASE WHEN sum(c) > sum(m) AND sum(c) > sum(d0) THEN 'COMBUSTIVEL'
            WHEN sum(m) > sum(d0) THEN 'MANUTENCAO' ELSE 'DEPRECIACAO' END AS principal_causa
FROM u GROUP BY tipo_veiculo, idade""").replace(")\n, u AS", "),\nu AS", 1)

ORACLE["diag_idade_manutencao"] = over_star(f"""
SELECT idade AS idade_veiculo, {VEHICLES}, {avg('man', 2, 2)} AS custo_manutencao_medio,
       {avg('cpk', 4, 4)} AS custo_por_km_medio, {avg('disp', 1, 1)} AS disponibilidade,
       {avg('kml', 2, 2)} AS consumo_real
FROM f GROUP BY idade""")

ORACLE["diag_anomalia_consumo"] = over_star(f"""
SELECT sigla_estado, regiao, tipo_veiculo, {avg('preco', 2, 2)} AS preco_combustivel,
       {avg('kml', 2, 2)} AS consumo_real, CAST(esperado AS DOUBLE) / 100e0 AS consumo_esperado,
       {DEVIATION} AS desvio_consumo_pct,
       CASE WHEN sum(kml) * 100 < esperado * 70 * count(kml) THEN 'ANOMALO'
            WHEN sum(kml) * 100 < esperado * 85 * count(kml) THEN 'SUBOTIMO' ELSE 'NORMAL' END AS status_consumo
FROM {F_V_E} GROUP BY sigla_estado, regiao, tipo_veiculo, esperado""")

# --- prescriptive -----------------------------------------------------------------

KPI_UNITS = {
    "custo_por_km": ("cpk", 4, 4), "margem_operacional": ("margem", 4, 4),
    "disponibilidade_pct": ("disp", 1, 1), "km_por_litro_real": ("kml", 2, 2),
}
VEHICLE_KPIS = f"""
SELECT id_veiculo, tipo_veiculo, marca, ano_fabricacao, status, combustivel, sigla_estado,
       {', '.join(f'{avg(*u)} AS {k}' for k, u in KPI_UNITS.items())},
       idade AS idade_veiculo, {money('total')} AS custo_total, {money('rec')} AS receita_total
FROM {F_V_E}
GROUP BY id_veiculo, tipo_veiculo, marca, ano_fabricacao, status, combustivel, sigla_estado, idade"""
ORACLE["presc_vehicle_kpis"] = over_star(VEHICLE_KPIS)


# Fixed values, written out here apart from the list that the Spark side reads: critical limit, attention
# limit and the worse side of each KPI.
LIMITS = {
    "custo_por_km": (2.5, 1.8, "higher"),
    "margem_operacional": (0.1, 0.2, "lower"),
    "disponibilidade_pct": (75.0, 85.0, "lower"),
    "km_por_litro_real": (3.0, 4.5, "lower"),
}


def kpi_rows(extra: bool = False) -> str:
    """Long KPI rows with class and limit, one SELECT per KPI."""
    selects = []
    for kpi, (critical, attention, worse) in LIMITS.items():
        op = ">" if worse == "higher" else "<"
        hit = f"CASE WHEN {kpi} {op} {critical}e0 THEN {{0}} WHEN {kpi} {op} {attention}e0 THEN {{1}} {{2}} END"
        selects.append(
            f"SELECT *, '{kpi}' AS kpi, {kpi} AS valor_atual,"
            f" {hit.format(f'{critical}e0', f'{attention}e0', '')} AS limite,"
            f" {hit.format(chr(39) + 'CRITICO' + chr(39), chr(39) + 'ATENCAO' + chr(39), 'ELSE ' + chr(39) + 'NORMAL' + chr(39))}"
            " AS classificacao FROM w"
        )
    if extra:
        selects.append(
            "SELECT *, 'custo_total' AS kpi, custo_total AS valor_atual, CAST(NULL AS DOUBLE) AS limite,"
            " 'INDEFINIDO' AS classificacao FROM w"
        )
    return "\nUNION ALL\n".join(selects)


def rules(select: str, extra: bool = False) -> str:
    return f"WITH {STAR},\nw AS ({VEHICLE_KPIS}),\nlong AS ({kpi_rows(extra)})\n{select}"


ACTION = "CASE kpi || '_' || classificacao {} ELSE '{}' END".format(
    " ".join(f"WHEN '{k}' THEN '{t}'" for k, t in ACTIONS.items()), DEFAULT_ACTION
)


def advice(age: str) -> str:
    whens = " ".join(f"WHEN {age} BETWEEN {a} AND {b} THEN '{t}'" for a, b, t in AGE_ADVICE)
    return f"CASE {whens} ELSE '{DEFAULT_ADVICE}' END"


ORACLE["presc_classify"] = rules(
    "SELECT id_veiculo, sigla_estado, idade_veiculo, kpi, valor_atual, limite, classificacao FROM long", extra=True
)
ORACLE["presc_action_lookup"] = rules(
    f"SELECT kpi, classificacao, {ACTION} AS acao, count(*) AS n FROM long GROUP BY ALL"
)
ALERTS = f"""SELECT id_veiculo AS veiculo_id, tipo_veiculo, marca, sigla_estado AS estado, kpi, valor_atual, limite,
       classificacao, {ACTION} AS acao_recomendada FROM long WHERE classificacao <> 'NORMAL'"""
ORACLE["presc_alerts"] = rules(ALERTS)
ORACLE["presc_age_recommendation"] = over_star(
    f"SELECT CAST(idade - 3 AS INTEGER) AS idade, {advice('idade - 3')} AS recomendacao, count(*) AS n FROM f GROUP BY ALL"
)
DECIDED = f"""per AS (
  SELECT id_veiculo AS id0, count(*) FILTER (classificacao = 'CRITICO') AS cr,
         count(*) FILTER (classificacao = 'ATENCAO') AS atn FROM long GROUP BY id_veiculo),
dec AS (
  SELECT id_veiculo AS veiculo_id, tipo_veiculo, marca, sigla_estado AS estado, custo_por_km, margem_operacional,
         idade_veiculo,
         CASE WHEN cr > 0 THEN '{DECISIONS[0]}' WHEN atn > 0 THEN '{DECISIONS[1]}'
              ELSE '{DECISIONS[2]}' END AS decisao,
         CAST(CASE WHEN cr > 0 THEN 1 WHEN atn > 0 THEN 2 ELSE 3 END AS INTEGER) AS prioridade,
         {advice('idade_veiculo')} AS recomendacao_idade, cr + atn AS num_alertas
  FROM w JOIN per ON w.id_veiculo = per.id0)"""


def decided(select: str) -> str:
    return f"WITH {STAR},\nw AS ({VEHICLE_KPIS}),\nlong AS ({kpi_rows()}),\n{DECIDED}\n{select}"


ORDER = "ORDER BY prioridade, veiculo_id, estado, idade_veiculo"
ORACLE["presc_decisions"] = decided("SELECT * FROM dec")
ORACLE["presc_top_n"] = decided(f"SELECT * FROM dec {ORDER} LIMIT 10")
ORACLE["dash_tbl1"] = decided(f"SELECT * FROM dec {ORDER} LIMIT 30")
ORACLE["presc_top_n_alertas"] = rules(
    f"SELECT * FROM ({ALERTS}) WHERE classificacao = 'CRITICO' ORDER BY veiculo_id, estado, kpi, valor_atual LIMIT 10"
)
COUNTS = ", ".join(
    f"count(*) FILTER (prioridade = {i}) AS {name}"
    for i, name in enumerate(["intervencao_imediata", "monitorar_planejar", "operacao_normal"], 1)
)
RESUMO = f"""SELECT count(*) AS total_linhas, count(DISTINCT veiculo_id) AS total_veiculos, {COUNTS},
       (SELECT count(*) FROM long WHERE classificacao <> 'NORMAL') AS total_alertas,
       (SELECT count(*) FROM long WHERE classificacao = 'CRITICO') AS alertas_criticos,
       (SELECT count(*) FROM long WHERE classificacao = 'ATENCAO') AS alertas_atencao FROM dec"""
ORACLE["presc_resumo"] = decided(RESUMO)
SUMMARY_FIELDS = [
    "total_linhas", "total_veiculos", "intervencao_imediata", "monitorar_planejar", "operacao_normal",
    "total_alertas", "alertas_criticos", "alertas_atencao",
]
ORACLE["sink_summary"] = decided(
    "SELECT 'data=20240229; ' || " + " || '; ' || ".join(f"'{c}=' || CAST({c} AS VARCHAR)" for c in SUMMARY_FIELDS)
    + f" AS texto FROM ({RESUMO})"
)
ORACLE["sink_results"] = rules(
    f"SELECT 'alertas' AS tabela, count(*) AS n, CAST(sum(CAST(limite AS DECIMAL(12,4))) AS DOUBLE) AS soma_limites FROM ({ALERTS})"
)
ORACLE["presc_pipeline"] = decided(
    "SELECT classificacao AS classe, count(*) AS n, round(sum(limite), 4) AS soma FROM long WHERE classificacao <> 'NORMAL' GROUP BY 1"
    " UNION ALL SELECT decisao, count(*), CAST(sum(num_alertas) AS DOUBLE) FROM dec GROUP BY 1"
)
# Fixed values of the reference tables: the action of each alert, the advice of each age, CO2 by fuel.
ORACLE["ref_tables"] = rules("""
SELECT long.kpi || '/' || classificacao || '/' || acao AS chave, count(*) AS n, round(sum(valor), 2) AS soma
FROM long JOIN (VALUES
  ('custo_por_km', 'CRITICO', 2.5e0, 'Substituir ou revisar operação'),
  ('custo_por_km', 'ATENCAO', 1.8e0, 'Monitorar e planejar manutenção'),
  ('margem_operacional', 'CRITICO', 0.1e0, 'Rever rota e composição de custos'),
  ('margem_operacional', 'ATENCAO', 0.2e0, 'Otimizar custos operacionais'),
  ('disponibilidade_pct', 'CRITICO', 75e0, 'Frota com baixa disponibilidade'),
  ('disponibilidade_pct', 'ATENCAO', 85e0, 'Verificar manutenção preventiva'),
  ('km_por_litro_real', 'CRITICO', 3e0, 'Verificar consumo anômalo'),
  ('km_por_litro_real', 'ATENCAO', 4.5e0, 'Monitorar eficiência do veículo')
) AS r(kpi, alerta, valor, acao) ON long.kpi = r.kpi AND classificacao = alerta GROUP BY ALL
UNION ALL
SELECT faixa || '/' || texto, count(*), CAST(sum(ate) AS DOUBLE) FROM w JOIN (VALUES
  ('Nova', 0, 3, 'Manutenção preventiva padrão'), ('Jovem', 4, 6, 'Acompanhar custo de manutenção'),
  ('Madura', 7, 9, 'Planejar substituição'), ('Antiga', 10, 14, 'Avaliar substituição imediata'),
  ('Obsoleta', 15, 99, 'Substituir obrigatoriamente')
) AS a(faixa, de, ate, texto) ON idade_veiculo BETWEEN de AND ate GROUP BY ALL
UNION ALL
SELECT fuel, count(*), sum(co2) FROM w JOIN (VALUES ('Diesel', 158e0), ('Flex', 120e0)) AS c(fuel, co2)
ON combustivel = fuel GROUP BY ALL""")
ORACLE["dash_decision_counts"] = decided(f"SELECT {COUNTS} FROM dec")
ORACLE["dash_g13"] = decided("SELECT tipo_veiculo, decisao, count(*) AS qtd FROM dec GROUP BY ALL")
ORACLE["dash_g14"] = rules("SELECT kpi, count(*) AS qtd FROM long WHERE classificacao <> 'NORMAL' GROUP BY kpi")

# --- dashboard --------------------------------------------------------------------

ORACLE["dash_cards"] = over_star(f"""
SELECT {avg('cpk', 4, 2)} AS custo_km, {avg('margem', 2, 1)} AS margem, {avg('disp', 1, 1)} AS disp,
       count(DISTINCT k) AS veiculos, {avg('kml', 2, 2)} AS consumo, {whole('km')} AS km,
       {whole('viagens')} AS viagens, {scaled(half_up('sum(rec)', '100'), 0)} AS receita,
       {scaled(half_up('sum(total)', '100'), 0)} AS custo_total,
       {scaled(half_up('(sum(rec) - sum(total))', '100'), 0)} AS lucro,
       {scaled(half_up('sum(man)', '100'), 0)} AS manutencao
FROM f""")
ORACLE["dash_g1"] = over_star(
    f"SELECT ano, mes, {MONTHS}[mes] AS nome_mes, tipo_veiculo, {avg('cpk', 4, 6)} AS custo_km FROM {F_V}"
    " GROUP BY ano, mes, tipo_veiculo"
)
ORACLE["dash_g2"] = over_star(f"SELECT ano, {money('rec')} AS receita, {money('total')} AS custo FROM f GROUP BY ano")
ORACLE["dash_g3"] = over_star(f"SELECT regiao, {avg('cpk', 4, 6)} AS custo_km FROM {F_E} GROUP BY regiao")
ORACLE["dash_g4"] = over_star(
    f"SELECT tipo_veiculo, {money('comb')} AS combustivel, {money('man')} AS manutencao, {money('seg')} AS seguro,"
    f" {money('dep')} AS depreciacao FROM {F_V} GROUP BY tipo_veiculo"
)
ORACLE["dash_g5"] = over_star(f"SELECT tipo_veiculo, {avg('cpk', 4, 6)} AS custo_km FROM {F_V} GROUP BY tipo_veiculo")
ORACLE["dash_g6"] = over_star(
    f"SELECT tipo_veiculo, {avg('kml', 2, 6)} AS real, {avg('esperado', 2, 6)} AS esperado FROM {F_V} GROUP BY tipo_veiculo"
)
ORACLE["dash_g10"] = over_star(
    f"SELECT ano, {money('man')} AS manutencao, {money('comb')} AS combustivel FROM f GROUP BY ano"
)
ORACLE["dash_g12"] = over_star(
    f"SELECT tipo_veiculo, {avg('disp', 1, 6)} AS disp, CASE WHEN sum(disp) < 750 * count(disp) THEN 'CRITICO'"
    f" WHEN sum(disp) < 850 * count(disp) THEN 'ATENCAO' ELSE 'NORMAL' END AS faixa FROM {F_V} GROUP BY tipo_veiculo"
)

# --- star -------------------------------------------------------------------------

ORACLE["fact_project_cast"] = over_star(
    f"SELECT k AS sk_veiculo, uf AS sk_estado, sk_tempo, {fact_columns()} FROM f"
)
ORACLE["src_star_wide"] = over_star(
    f"SELECT {fact_columns()}, k AS sk_veiculo, uf AS sk_estado, sk_tempo, tipo_veiculo, id_veiculo, marca,"
    " CAST(esperado AS DOUBLE) / 100e0 AS consumo_medio_km_l, sigla_estado, regiao, ano, mes,"
    f" {MONTHS}[mes] AS nome_mes FROM {F_V_E}"
)
TIME_COLUMNS = f"""CAST(ano * 100 + mes AS INTEGER) AS sk_tempo, ano, mes,
       CAST((mes - 1) // 3 + 1 AS INTEGER) AS trimestre,
       CAST(CASE WHEN mes <= 6 THEN 1 ELSE 2 END AS INTEGER) AS semestre, {MONTHS}[mes] AS nome_mes"""
ORACLE["dim_tempo"] = over_star(
    f"SELECT {TIME_COLUMNS} FROM (SELECT DISTINCT ano FROM f) JOIN (SELECT DISTINCT mes FROM f) ON true"
)
# written out here, apart from the lists that the Spark side reads
UFS = """['RO', 'AC', 'AM', 'RR', 'PA', 'AP', 'TO', 'MA', 'PI', 'CE', 'RN', 'PB', 'PE', 'AL', 'SE', 'BA', 'MG', 'ES',
 'RJ', 'SP', 'PR', 'SC', 'RS', 'MS', 'XX']"""
ORACLE["dim_estado"] = over_star(f"""
SELECT CAST(row_number() OVER (ORDER BY sigla_estado) AS INTEGER) AS sk_estado, sigla_estado,
       CASE WHEN uf < 7 THEN 'NORTE' WHEN uf < 16 THEN 'NORDESTE' WHEN uf < 20 THEN 'SUDESTE' WHEN uf < 23 THEN 'SUL'
            WHEN uf = 23 THEN 'CENTRO OESTE' ELSE 'DESCONHECIDO' END AS regiao
FROM (SELECT DISTINCT uf, {UFS}[uf + 1] AS sigla_estado FROM f)""")
CLEAN_KM = "CASE WHEN km_atual = 0 THEN NULL ELSE CAST(km_atual AS DOUBLE) END"
ORACLE["dim_veiculo"] = over_star(
    f"SELECT row_number() OVER (ORDER BY sk // 65536, id_veiculo) AS sk_veiculo, id_veiculo, tipo_veiculo, marca,"
    f" ano_fabricacao, combustivel, {CLEAN_KM} AS km_atual, status,"
    " CAST(esperado AS DOUBLE) / 100e0 AS consumo_medio_km_l, CAST(carga AS DOUBLE) AS capacidade_carga_t FROM v"
)
ORACLE["dim_veiculo_hash"] = over_star(
    "SELECT id_veiculo, tipo_veiculo, CAST(1 AS BIGINT) AS ids_por_chave, count(k) AS operacoes"
    " FROM v LEFT JOIN f ON k = sk GROUP BY id_veiculo, tipo_veiculo"
)
ORACLE["dim_veiculo_colisoes"] = over_star(
    "SELECT sk % 7 AS sk_veiculo, count(*) AS ids, min(id_veiculo) AS primeiro_id, max(id_veiculo) AS ultimo_id"
    " FROM v GROUP BY sk % 7 HAVING count(*) > 1"
)
ORACLE["fact_surrogate_key"] = over_star(
    "SELECT row_number() OVER (ORDER BY sk_tempo) AS sk_fato_frota, sk_tempo FROM f"
)
ORACLE["star_join_tempo"] = over_star(
    f"SELECT ano, CAST((mes - 1) // 3 + 1 AS INTEGER) AS trimestre, CAST(CASE WHEN mes <= 6 THEN 1 ELSE 2 END AS INTEGER)"
    f" AS semestre, {MONTHS}[mes] AS nome_mes, count(*) AS n, {whole('km')} AS km FROM f GROUP BY ano, mes"
)
ORACLE["star_join_estado"] = over_star(
    f"SELECT sigla_estado, regiao, count(*) AS n, {whole('km')} AS km FROM {F_E} GROUP BY sigla_estado, regiao"
)
ORACLE["star_join_veiculo"] = over_star(
    f"SELECT id_veiculo, marca, status, count(*) AS n, {whole('km')} AS km FROM {F_V} GROUP BY id_veiculo, marca, status"
)
for _name, _expr in {
    "derive_custo_total": ("custo_total", "CAST(total AS DOUBLE) / 100e0"),
    "derive_custo_por_km": ("custo_por_km", f"CASE WHEN km > 0 THEN {quotient('total', 'nullif(km, 0) * 100', 6)} ELSE 0e0 END"),
    "derive_margem": ("margem_operacional", f"CASE WHEN rec > 0 THEN {quotient('(rec - total)', 'nullif(rec, 0)', 6)} ELSE 0e0 END"),
    "derive_km_por_litro": ("km_por_litro_real", f"CASE WHEN litros > 0 THEN {quotient('km * 100', 'nullif(litros, 0)', 6)} ELSE 0e0 END"),
    "derive_idade": ("idade_veiculo", "idade"),
}.items():
    ORACLE[_name] = over_star(
        f"SELECT k AS sk_veiculo, sk_tempo, CAST(km AS INTEGER) AS km_rodado, {_expr[1]} AS {_expr[0]} FROM f"
    )
TOTAL_COST = "CAST(sum(total) AS DOUBLE) / 100e0"
ORACLE["view_registry"] = over_star(f"""
SELECT 'vw_resumo_mensal' AS visao, count(DISTINCT sk_tempo) AS n, {TOTAL_COST} AS soma FROM f
UNION ALL SELECT 'vw_kpi_estado', count(DISTINCT uf), {TOTAL_COST} FROM f
UNION ALL SELECT 'vw_kpi_tipo_veiculo', count(DISTINCT tipo_veiculo || combustivel), {TOTAL_COST} FROM {F_V}
UNION ALL SELECT 'vw_veiculos_alto_custo', count(*), round(sum(custo_total_periodo), 2) FROM ({HIGH_COST})
UNION ALL SELECT 'vw_impacto_combustivel', count(*), sum(t) / 100e0 FROM (
  SELECT CAST(sum(total) AS DOUBLE) AS t FROM {F_V} GROUP BY sk_tempo, uf, tipo_veiculo)
UNION ALL SELECT 'vw_eficiencia_idade', count(*), CAST(sum(c) AS DOUBLE) FROM (
  SELECT count(DISTINCT k) AS c FROM f GROUP BY {band(AGE_BANDS, AGE_BAND_ABOVE)})
UNION ALL SELECT 'vw_ranking_margem', count(*), sum(t) / 100e0 FROM (SELECT CAST(sum(total) AS DOUBLE) AS t FROM f GROUP BY k, uf)""")
NOT_NULL = [
    ("dim_tempo", ["sk_tempo", "ano", "mes", "trimestre", "semestre", "nome_mes"]),
    ("dim_estado", ["sk_estado", "sigla_estado", "regiao"]),
    ("dim_veiculo", ["sk_veiculo", "id_veiculo", "tipo_veiculo", "marca", "ano_fabricacao", "combustivel"]),
    ("fato_frota", ["sk_veiculo", "sk_estado", "sk_tempo"]),
]
ORACLE["dq_constraints"] = over_star("\nUNION ALL\n".join(
    [
        "SELECT 'dim_tempo' AS tabela, 'pk sk_tempo' AS verificacao, CAST(0 AS BIGINT) AS violacoes",
        "SELECT 'dim_estado', 'pk sk_estado', count(*) FROM e WHERE regiao = 'ASIA'",
        "SELECT 'dim_veiculo', 'pk sk_veiculo', CAST(0 AS BIGINT)",
        "SELECT 'fato_frota', 'not null km_rodado', count(*) FROM f WHERE km = 0",
        "SELECT 'fato_frota', 'fk sk_veiculo', count(*) FROM f LEFT JOIN v ON k = sk AND ano_fabricacao >= 1983 WHERE sk IS NULL",
        "SELECT 'fato_frota', 'fk sk_estado', CAST(0 AS BIGINT)",
        "SELECT 'fato_frota', 'fk sk_tempo', CAST(0 AS BIGINT)",
        "SELECT 'fato_frota', 'pk sk_fato_frota', count(*) FROM"
        " (SELECT sk_tempo FROM f WHERE viagens = 56 GROUP BY sk_tempo HAVING count(*) > 1)",
    ]
    + [f"SELECT '{t}', 'not null {c}', CAST(0 AS BIGINT)" for t, cols in NOT_NULL for c in cols]
))

# --- raw feeds --------------------------------------------------------------------

RAW_PRICES = f"""
state AS (
  SELECT CAST(n_nationkey AS INTEGER) AS uf, n_name AS nome, r_name AS regiao
  FROM nation JOIN region ON n_regionkey = r_regionkey),
raw AS (
  SELECT regiao, nome AS estado, 'Cidade ' || CAST(l_partkey % 100 AS VARCHAR) AS municipio,
         ([{', '.join(f"'{p}'" for p in PRODUCTS)}])[1 + l_partkey % 6] AS produto,
         CASE WHEN floor(l_discount * 100 + 0.5e0) = 10 THEN '31/02/' || strftime(l_shipdate, '%Y')
              ELSE strftime(l_shipdate, '%d/%m/%Y') END AS texto_data,
         {half_up('CAST(floor(l_extendedprice * 100 + 0.5e0) AS BIGINT)', 'CAST(floor(l_quantity) AS BIGINT)')} AS preco,
         floor(l_tax * 100 + 0.5e0) AS t, l_linenumber > 5 AS sem_compra
  FROM lineitem JOIN state ON uf = {STATE.format(k='l_suppkey')}),
cells AS (
  SELECT regiao, estado, municipio, produto, texto_data,
         CASE WHEN t = 8 THEN 'abc' WHEN t = 7 THEN 'nan' END AS venda_ruim,
         CASE WHEN t < 7 THEN preco END AS venda, CASE WHEN NOT sem_compra THEN preco END AS compra,
         CAST(try_strptime(texto_data, '%d/%m/%Y') AS DATE) AS data
  FROM raw),
clean AS (
  SELECT * FROM (SELECT DISTINCT * FROM cells) WHERE venda IS NOT NULL)
"""
PADDED = "' ' || chr(9) || lower(estado) || '  '"


def money_text(c: str) -> str:
    return f"(CAST({c} // 100 AS VARCHAR) || '.' || lpad(CAST({c} % 100 AS VARCHAR), 2, '0'))"


def over_prices(select: str) -> str:
    return f"WITH {RAW_PRICES}\n{select}"


ORACLE["clean_rename"] = over_prices(
    f"SELECT {PADDED} AS estado, lower(produto) || ' ' AS produto, texto_data AS data_coleta,"
    f" coalesce(venda_ruim, {money_text('venda')}) AS valor_venda, 'BRANCA' AS bandeira, 'R$/l' AS unidade_medida FROM cells"
)
ORACLE["clean_dedup_full"] = over_prices(
    f"SELECT lower(regiao) AS regiao, {PADDED} AS estado, municipio, lower(produto) || ' ' AS produto,"
    f" texto_data AS data_coleta, coalesce(venda_ruim, {money_text('venda')}) AS valor_venda,"
    f" coalesce({money_text('compra')}, '') AS valor_compra FROM (SELECT DISTINCT * FROM cells)"
)
ORACLE["clean_dedup_key"] = """
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) = 1"""
ORACLE["clean_to_numeric"] = over_prices(
    f"SELECT lower(produto) || ' ' AS produto, count(*) AS n, count(venda) AS n_venda, {money('venda')} AS soma_venda,"
    f" count(compra) AS n_compra, {money('compra')} AS soma_compra FROM cells GROUP BY produto"
)
ORACLE["clean_dropna"] = over_prices(
    f"SELECT {PADDED} AS estado, count(*) AS n FROM cells WHERE venda IS NOT NULL GROUP BY cells.estado"
)
ORACLE["clean_upper_strip"] = over_prices(
    "SELECT upper(regiao) AS regiao, estado, produto, count(*) AS n FROM cells GROUP BY ALL"
)
ORACLE["clean_parse_date"] = over_prices(
    "SELECT texto_data AS texto, CAST(data AS VARCHAR) AS data, count(*) AS n FROM cells GROUP BY ALL"
)
YEAR_MONTH = "CAST(coalesce(year(data), 0) AS INTEGER) AS ano, CAST(coalesce(month(data), 0) AS INTEGER) AS mes"
ORACLE["clean_date_parts"] = over_prices(f"SELECT {YEAR_MONTH}, count(*) AS n FROM cells GROUP BY ALL")
ORACLE["clean_anp"] = over_prices(
    f"SELECT regiao, estado, municipio, produto, CAST(data AS VARCHAR) AS data_coleta,"
    f" CAST(venda AS DOUBLE) / 100e0 AS valor_venda, CAST(compra AS DOUBLE) / 100e0 AS valor_compra, {YEAR_MONTH} FROM clean"
)
MONTHLY = f"""
monthly AS (
  SELECT estado, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, produto,
         {half_even('sum(venda)', 'count(venda)')} AS medio, min(venda) AS menor, max(venda) AS maior, count(venda) AS n
  FROM clean WHERE data IS NOT NULL GROUP BY ALL)"""
ORACLE["std_price_monthly"] = f"""WITH {RAW_PRICES}, {MONTHLY}
SELECT estado, ano, mes, produto, CAST(medio AS DOUBLE) / 100e0 AS preco_medio, CAST(menor AS DOUBLE) / 100e0 AS preco_min,
       CAST(maior AS DOUBLE) / 100e0 AS preco_max, n AS num_registros FROM monthly"""


# Column of each product in the wide price table.
PRICE_COLUMNS = {
    "GASOLINA": "preco_gasolina",
    "ETANOL": "preco_etanol",
    "DIESEL": "preco_diesel",
    "DIESEL S10": "preco_diesel_s_s10",
    "GNV": "preco_gnv",
    "GASOLINA ADITIVADA": "preco_gasolina_aditivada",
}
PIVOTED = ", ".join(
    f"CAST(max(medio) FILTER (produto = '{p}') AS DOUBLE) / 100e0 AS {c}" for p, c in PRICE_COLUMNS.items()
)
ORACLE["std_price_pivot"] = f"WITH {RAW_PRICES}, {MONTHLY} SELECT estado, ano, mes, {PIVOTED} FROM monthly GROUP BY estado, ano, mes"
ORACLE["std_price_names"] = f"""WITH {RAW_PRICES}, {MONTHLY}
SELECT CASE produto {' '.join(f"WHEN '{p}' THEN '{c}'" for p, c in PRICE_COLUMNS.items())} END AS coluna,
       count(*) AS n, CAST(sum(medio) AS DOUBLE) / 100e0 AS soma FROM monthly GROUP BY 1"""

INDICATOR_ROWS = f"""
irow AS (
  SELECT DISTINCT upper(o_orderpriority) AS indicador, o_orderstatus AS descricao, strftime(o_orderdate, '%Y') AS periodo,
         CAST(floor(o_totalprice * 100 + 0.5e0) AS BIGINT) AS valor, n_name AS estado
  FROM orders JOIN nation ON n_nationkey = {STATE.format(k='o_custkey')} WHERE o_orderstatus <> 'P')
"""


def over_indicators(select: str) -> str:
    return f"WITH {INDICATOR_ROWS}\n{select}"


ORACLE["clean_period_string"] = "SELECT strftime(o_orderdate, '%Y') AS periodo, count(*) AS n FROM orders GROUP BY 1"
ORACLE["clean_ibge"] = over_indicators(
    "SELECT indicador, descricao, periodo, CAST(valor AS DOUBLE) / 100e0 AS valor, estado FROM irow"
)


def indicator_pivot() -> str:
    def one(p: str) -> str:
        own = f"FILTER (indicador = '{p}')"
        mean = half_up(f"sum(valor) {own} * 10000", f"nullif(count(valor) {own}, 0)")
        return f'{scaled(mean, 6)} AS "{p}"'

    return ", ".join(one(p) for p in PRIORITIES)


WIDE = f"SELECT estado, periodo AS ano, {indicator_pivot()} FROM irow GROUP BY estado, periodo"
ORACLE["std_indicator_wide"] = over_indicators(WIDE)
ORACLE["std_indicator_wide_national"] = over_indicators(f"SELECT periodo, {indicator_pivot()} FROM irow GROUP BY periodo")
JSON_VALUES = """SELECT indicador, periodo,
       CASE WHEN CAST(periodo AS INTEGER) % 5 <> length(estado) % 5 THEN CAST(sum(valor) AS DOUBLE) / 100e0 END AS valor,
       lower(estado) AS {p}_id, estado AS {p}_nome FROM irow GROUP BY indicador, estado, periodo"""
ORACLE["src_json_indicator"] = over_indicators(JSON_VALUES.format(p="localidade"))
ORACLE["src_json_indicator_uf"] = over_indicators(JSON_VALUES.format(p="uf"))
ORACLE["src_json_props"] = """
SELECT event_type, 'k' AS chave, count(v) AS n, sum(v) AS soma
FROM (SELECT event_type, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS v FROM events) GROUP BY event_type"""
ORACLE["src_union_indicators"] = over_indicators(f"""
SELECT indicador, CASE WHEN indicador = '{PRIORITIES[0]}' THEN 'BRASIL' ELSE estado END AS estado, count(*) AS n,
       {money('valor')} AS soma FROM irow GROUP BY 1, 2""")
ORACLE["ref_upsert"] = over_indicators(f""", g AS (
  SELECT indicador, estado, periodo >= '1998' AS nova, {avg('valor', 2, 2)} AS valor_limite, count(*) AS n
  FROM irow GROUP BY ALL)
SELECT indicador, estado, valor_limite, n FROM g
QUALIFY row_number() OVER (PARTITION BY indicador, estado ORDER BY nova DESC) = 1""").replace(")\n\n, g AS", "),\ng AS", 1)
CATALOG = ", ".join(f"('{n}', '{a}', '{d}')" for n, a, d in INDICATORS)
ORACLE["src_indicator_lookup"] = f"""
SELECT indicador, agregado, descricao, count(*) AS n
FROM (SELECT (['ipca', 'Pib', 'SALARIO', 'populacao', 'selic'])[1 + o_custkey % 5] AS indicador FROM orders)
LEFT JOIN (VALUES {CATALOG}) AS c(nome, agregado, descricao) ON upper(indicador) = nome GROUP BY ALL"""

FLEET_ROWS = """
reg AS (
  SELECT CAST(1995 + c_custkey % 7 AS INTEGER) AS ano, n_name AS estado, c_mktsegment AS tipo_veiculo,
         CASE c_custkey % 3 WHEN 0 THEN 'GASOLINA' WHEN 1 THEN 'FLEX' END AS combustivel,
         CASE WHEN c_acctbal >= 0 THEN c_custkey END AS quantidade
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
ok AS (SELECT DISTINCT * FROM reg WHERE quantidade IS NOT NULL)
"""


def over_fleet(select: str) -> str:
    return f"WITH {FLEET_ROWS}\n{select}"


IN_USE = ", ".join(f"'{s}'" for s in SEGMENTS_IN_USE)
SUMMARY = f"""SELECT estado, ano, CAST(sum(quantidade) AS DOUBLE) AS frota_total,
       count(DISTINCT tipo_veiculo) AS num_tipos,
       CAST(coalesce(sum(quantidade) FILTER (tipo_veiculo IN ({IN_USE})), 0) AS BIGINT) AS frota_operacional
FROM ok GROUP BY estado, ano"""
ORACLE["clean_denatran"] = over_fleet(
    "SELECT ano, estado, tipo_veiculo, coalesce(combustivel, '?') AS combustivel, CAST(quantidade AS DOUBLE) AS quantidade FROM ok"
)
ORACLE["std_fleet_summary"] = over_fleet(f"SELECT * EXCLUDE (frota_operacional) FROM ({SUMMARY})")
ORACLE["std_fleet_operational"] = over_fleet(f"SELECT * EXCLUDE (num_tipos) FROM ({SUMMARY})")
ORACLE["src_csv_scan"] = over_fleet(
    "SELECT ano, coalesce(lower(combustivel), '?') AS combustivel, count(*) AS n, count(*) AS com_texto FROM reg GROUP BY 1, 2"
)
ORACLE["src_latest_snapshot"] = over_fleet("SELECT ano, count(*) AS n FROM reg GROUP BY ano")
ORACLE["src_staging_pick"] = (
    "SELECT 'frota_enriquecida' AS tabela, count(*) AS n, CAST(sum((CAST(floor(l_quantity) AS BIGINT) - 1) * 100) AS BIGINT) AS soma"
    " FROM lineitem UNION ALL SELECT 'veiculos_clean', count(*), CAST(sum((s_suppkey % 500) * 700) AS BIGINT) FROM supplier"
)
ORACLE["sink_staging"] = f"""WITH {STAR}, {RAW_PRICES}, {MONTHLY}, {INDICATOR_ROWS}, {FLEET_ROWS}
SELECT 'anp_mensal' AS tabela, count(DISTINCT (estado, ano, mes)) AS n,
       round(CAST(sum(medio) FILTER (produto = 'DIESEL') AS DOUBLE) / 100e0, 2) AS soma FROM monthly
UNION ALL SELECT 'ibge_wide', count(*), round(sum("1-URGENT"), 2) FROM ({WIDE})
UNION ALL SELECT 'denatran_resumo', count(*), round(sum(frota_total), 2) FROM ({SUMMARY})
UNION ALL SELECT 'veiculos_clean', count(*), CAST(sum(km_atual) AS DOUBLE) FROM v
UNION ALL SELECT 'frota_enriquecida', count(*), round(CAST(sum(rec) AS DOUBLE) / 100e0, 2) FROM f"""

# --- vehicles, operations, enrichment -----------------------------------------------

ORACLE["clean_strip"] = over_star(
    "SELECT id_veiculo AS veiculo_id, tipo_veiculo, marca, combustivel FROM v"
    " UNION ALL SELECT id_veiculo, tipo_veiculo, 'Outra', combustivel FROM v"
)
ORACLE["clean_fleet"] = over_star(
    f"SELECT id_veiculo AS veiculo_id, tipo_veiculo, marca, ano_fabricacao, sigla_estado AS estado, combustivel,"
    f" CAST(esperado AS DOUBLE) / 100e0 AS consumo_medio_km_l, {CLEAN_KM} AS km_atual, status,"
    f" CAST(carga AS DOUBLE) AS capacidade_carga_t FROM v JOIN e ON e.sk = {STATE.format(k='v.sk')}"
)
OPERATION_MONEY = {
    "custo_combustivel": "comb", "custo_manutencao": "man", "custo_seguro": "seg", "custo_ipva": "ipva",
    "custo_depreciacao": "dep", "receita_estimada": "rec",
}
ORACLE["clean_fill_zero"] = over_star(
    "SELECT tipo_veiculo, mes, count(*) AS n, "
    + ", ".join(f"count(*) AS n_{c}, {money(x)} AS {c}" for c, x in OPERATION_MONEY.items())
    + f" FROM {F_V} GROUP BY tipo_veiculo, mes"
)
# operations after cleaning: copies of a row in every feed column are one row
OPS = f"""ops AS (
  SELECT DISTINCT k, uf, ano, mes, km, litros, preco, comb, man, seg, ipva, dep, rec, viagens, disp, total, cpk, sk_tempo,
         sigla_estado, v.* EXCLUDE (sk)
  FROM {F_V_E})"""
ORACLE["clean_fleet_operacoes"] = f"""WITH {STAR}, {OPS}
SELECT id_veiculo AS veiculo_id, tipo_veiculo, sigla_estado AS estado, ano, mes, CAST(km AS INTEGER) AS km_rodado,
       CAST(litros AS DOUBLE) / 100e0 AS litros_consumidos, CAST(preco AS DOUBLE) / 100e0 AS preco_combustivel,
       {', '.join(f'CAST({x} AS DOUBLE) / 100e0 AS {c}' for c, x in OPERATION_MONEY.items())},
       CAST(viagens AS INTEGER) AS viagens_realizadas, CAST(disp AS DOUBLE) / 10e0 AS disponibilidade_pct FROM ops"""
ORACLE["fact_key_lookup"] = f"""WITH {STAR}, {OPS}
SELECT k AS sk_veiculo, uf AS sk_estado, sk_tempo, count(*) AS n, {whole('km')} AS km
FROM ops GROUP BY k, uf, sk_tempo"""
ORACLE["enrich_vehicle"] = f"""WITH {STAR}, {OPS}
SELECT marca, status, ano, count(*) AS n, {whole('km')} AS km, CAST(sum(carga) AS DOUBLE) AS capacidade
FROM (SELECT marca, status, ano, km, carga FROM ops
      UNION ALL SELECT '?', '?', ano, km, NULL FROM ops WHERE viagens = 56) GROUP BY 1, 2, 3"""
ORACLE["enrich_price"] = f"""WITH {STAR}, {OPS}, {RAW_PRICES}, {MONTHLY},
wide AS (SELECT estado, ano, mes, {PIVOTED.replace('CAST(', '').replace(' AS DOUBLE) / 100e0', '')} FROM monthly
         WHERE ano < 2000 GROUP BY estado, ano, mes)
SELECT sigla_estado AS estado, ops.ano, ops.mes, count(*) AS n, {', '.join(f'{money(c)} AS {c}' for c in PRICE_COLUMNS.values())}
FROM ops LEFT JOIN wide ON sigla_estado = wide.estado AND ops.ano = wide.ano AND ops.mes = wide.mes
GROUP BY sigla_estado, ops.ano, ops.mes"""
INDICATOR_MAX = ", ".join(f'max("{p}") AS "{p}"' for p in PRIORITIES)
ORACLE["enrich_indicators"] = f"""WITH {STAR}, {OPS}, {INDICATOR_ROWS}, wide AS ({WIDE})
SELECT sigla_estado AS estado, ops.ano, count(*) AS n, {INDICATOR_MAX}
FROM ops LEFT JOIN wide ON sigla_estado = wide.estado AND ops.ano = CAST(wide.ano AS INTEGER) GROUP BY sigla_estado, ops.ano"""
ORACLE["enrich_registered_fleet"] = f"""WITH {STAR}, {OPS}, {FLEET_ROWS}, s AS ({SUMMARY})
SELECT sigla_estado AS estado, ops.ano, count(*) AS n, sum(frota_total) AS frota_total,
       CAST(sum(frota_operacional) AS DOUBLE) AS frota_operacional
FROM ops LEFT JOIN s ON sigla_estado = s.estado AND ops.ano = s.ano GROUP BY sigla_estado, ops.ano"""
UNROUNDED = f"CASE WHEN km > 0 THEN {half_up('total * 10000', 'nullif(km, 0)')} ELSE 0 END"
ORACLE["enrich_pipeline"] = f"""WITH {STAR}, {OPS}, {RAW_PRICES}, {MONTHLY}, {INDICATOR_ROWS}, {FLEET_ROWS},
p AS (SELECT estado, ano, mes, max(medio) FILTER (produto = 'DIESEL') AS diesel FROM monthly GROUP BY ALL),
i AS ({WIDE}), s AS ({SUMMARY})
SELECT sigla_estado AS estado, ops.ano, ops.mes, count(*) AS n, {whole('km')} AS km, {money('total')} AS custo_total,
       CAST(sum({UNROUNDED}) AS DOUBLE) / 1e6 AS soma_custo_km, CAST(max(diesel) AS DOUBLE) / 100e0 AS preco_diesel,
       max("1-URGENT") AS urgent, max(frota_total) AS frota_total, min(marca) AS marca
FROM ops LEFT JOIN p ON sigla_estado = p.estado AND ops.ano = p.ano AND ops.mes = p.mes
LEFT JOIN i ON sigla_estado = i.estado AND ops.ano = CAST(i.ano AS INTEGER)
LEFT JOIN s ON sigla_estado = s.estado AND ops.ano = s.ano GROUP BY sigla_estado, ops.ano, ops.mes"""
ORACLE["star_pipeline"] = f"""WITH {STAR}, {OPS}, ufs AS (
  SELECT sigla_estado AS sg, CAST(row_number() OVER (ORDER BY sigla_estado) AS INTEGER) AS sk_estado
  FROM (SELECT DISTINCT sigla_estado FROM ops))
SELECT sigla_estado, '{UNKNOWN_REGION}' AS regiao, sk_estado, ano, {MONTHS}[mes] AS nome_mes, tipo_veiculo,
       count(*) AS n, {whole('km')} AS km, {money('total')} AS custo_total,
       CAST(sum(cpk) AS DOUBLE) / 10000e0 AS soma_custo_km
FROM ops JOIN ufs ON sigla_estado = sg GROUP BY sigla_estado, sk_estado, ano, mes, tipo_veiculo"""

# --- predictive -------------------------------------------------------------------

FIELDS = """CAST(sum(cpk) AS DOUBLE) / (count(cpk) * 1e4) AS y, CAST(sum(comb) AS DOUBLE) / 100e0 AS comb,
         CAST(sum(man) AS DOUBLE) / 100e0 AS man, CAST(sum(km) AS BIGINT) AS km"""
KEYED = f"""m0 AS (SELECT tipo_veiculo, uf AS sk_estado, ano, mes, {FIELDS} FROM {F_V} GROUP BY ALL),
m AS (SELECT *, CAST((ano - min(ano) OVER (PARTITION BY tipo_veiculo, sk_estado)) * 12 + mes AS INTEGER) AS idx,
             min(ano) OVER (PARTITION BY tipo_veiculo, sk_estado) AS ano0 FROM m0)"""
TOTAL = f"""m0 AS (SELECT 'TOTAL' AS serie, ano, mes, {FIELDS} FROM f GROUP BY ALL),
m AS (SELECT *, CAST((ano - min(ano) OVER ()) * 12 + mes AS INTEGER) AS idx, min(ano) OVER () AS ano0 FROM m0)"""
BY_TYPE = f"m AS (SELECT tipo_veiculo, ano, mes, {FIELDS} FROM {F_V} GROUP BY ALL)"


def series_columns(keys: str) -> str:
    return f"""SELECT {keys}, ano, mes, {r('y', 6)} AS custo_por_km, comb AS custo_combustivel,
       man AS custo_manutencao, km AS km_rodado, idx AS periodo_idx FROM m"""


K2 = "tipo_veiculo, sk_estado"
ORACLE["pred_monthly_series"] = f"WITH {STAR}, {KEYED} {series_columns(K2)}"
ORACLE["pred_monthly_series_total"] = f"WITH {STAR}, {TOTAL} {series_columns('serie')}"
ORACLE["pred_last_period"] = f"""WITH {STAR}, {KEYED}
SELECT {K2}, CAST(max(ano * 100 + mes) // 100 AS INTEGER) AS ultimo_ano, CAST(max(ano * 100 + mes) % 100 AS INTEGER) AS ultimo_mes
FROM m GROUP BY {K2}"""


def regression(keys: str) -> str:
    """Least squares by Cramer's rule on centred values (distance and fuel cost in units of 10^4)."""
    sums = ", ".join(f"sum({a} * {b}) AS {a}{b}" for a, b in [
        ("p", "p"), ("p", "q"), ("p", "z"), ("q", "q"), ("q", "z"), ("z", "z"), ("p", "w"), ("q", "w"), ("z", "w"), ("w", "w"),
    ])

    def det(a, b, c, d, e, f_, g, h, i):
        return f"({a} * ({e} * {i} - {f_} * {h}) - {b} * ({d} * {i} - {f_} * {g}) + {c} * ({d} * {h} - {e} * {g}))"

    whole_ = det("pp", "pq", "pz", "pq", "qq", "qz", "pz", "qz", "zz")
    bp = det("pw", "pq", "pz", "qw", "qq", "qz", "zw", "qz", "zz")
    bq = det("pp", "pw", "pz", "pq", "qw", "qz", "pz", "zw", "zz")
    bz = det("pp", "pq", "pw", "pq", "qq", "qw", "pz", "qz", "zw")
    return f"""ctr AS (
  SELECT {keys}, ano, mes, ano0, idx - avg(idx) OVER s AS p, (km - avg(km) OVER s) / 1e4 AS q,
         (comb - avg(comb) OVER s) / 1e4 AS z, y - avg(y) OVER s AS w,
         avg(idx) OVER s AS mp, avg(km) OVER s / 1e4 AS mq, avg(comb) OVER s / 1e4 AS mz, avg(y) OVER s AS my
  FROM m WINDOW s AS (PARTITION BY {keys})),
gram AS (
  SELECT {keys}, {sums}, any_value(mp) AS mp, any_value(mq) AS mq, any_value(mz) AS mz, any_value(my) AS my,
         count(*) AS n, any_value(ano0) AS ano0, max(ano * 100 + mes) AS ultimo FROM ctr GROUP BY {keys}),
beta AS (SELECT *, {bp} / {whole_} AS b1, {bq} / {whole_} AS b2, {bz} / {whole_} AS b3 FROM gram),
fit AS (SELECT *, my - b1 * mp - b2 * mq - b3 * mz AS b0 FROM beta)"""


ORACLE["pred_linreg_fit"] = f"""WITH {STAR}, {KEYED}, {regression(K2)}
SELECT {K2}, {r('b0', 5)} AS intercepto, {r('b1', 6)} AS coef_periodo_idx, {r('b2 * 100', 4)} AS coef_km_rodado,
       {r('b3 * 100', 4)} AS coef_custo_combustivel, n FROM fit"""
ORACLE["pred_linreg_metrics"] = f"""WITH {STAR}, {KEYED}, {regression(K2)}
SELECT ctr.tipo_veiculo, ctr.sk_estado, {r('1 - sum((w - b1 * p - b2 * q - b3 * z) ** 2) / sum(w * w)', 6)} AS r2,
       {r('avg(abs(w - b1 * p - b2 * q - b3 * z))', 6)} AS mae
FROM ctr JOIN fit ON ctr.tipo_veiculo = fit.tipo_veiculo AND ctr.sk_estado = fit.sk_estado GROUP BY ALL"""


def regression_forecast(keys: str, km: float, fuel: float) -> str:
    return f"""nxt AS (
  SELECT *, CAST((ultimo % 100 + i - 1) % 12 + 1 AS INTEGER) AS mes, CAST(ultimo // 100 + (ultimo % 100 + i - 1) // 12 AS INTEGER) AS ano
  FROM fit, (SELECT unnest(range(1, 7)) AS i)),
prev AS (
  SELECT {keys}, ano, mes, {r(f'b0 + b1 * ((ano - ano0) * 12 + mes) + b2 * {km / 1e4} + b3 * {fuel / 1e4}', 4)} AS custo_por_km_previsto,
         'regressao_linear' AS modelo FROM nxt)"""


ORACLE["pred_linreg_forecast"] = f"""WITH {STAR}, {KEYED}, {regression(K2)}, {regression_forecast(K2, 10_000, 20_000)}
SELECT * FROM prev"""


def arima(keys: str) -> str:
    """Two least-squares stages on monthly changes."""
    def solve(a11, a12, a22, c1, c2):
        d = f"nullif(CASE WHEN abs({a11} * {a22} - {a12} * {a12}) > 1e-12 * {a11} * {a22} THEN {a11} * {a22} - {a12} * {a12} END, 0)"
        return f"({c1} * {a22} - {c2} * {a12}) / {d}", f"({c2} * {a11} - {c1} * {a12}) / {d}"

    a1, a2 = solve("s11", "s12", "s22", "s01", "s02")
    phi, theta = solve("t11", "t12", "t22", "t01", "t02")
    w = f"WINDOW o AS (PARTITION BY {keys} ORDER BY ano, mes)"
    return f"""d1 AS (SELECT {keys}, ano, mes, y, y - lag(y) OVER o AS w FROM m {w}),
d2 AS (SELECT *, lag(w) OVER o AS w1, lag(w, 2) OVER o AS w2 FROM d1 {w}),
st1 AS (
  SELECT {keys}, {a1} AS a1, {a2} AS a2 FROM (
    SELECT {keys}, sum(w1 * w1) AS s11, sum(w1 * w2) AS s12, sum(w2 * w2) AS s22, sum(w * w1) AS s01, sum(w * w2) AS s02
    FROM d2 WHERE w2 IS NOT NULL GROUP BY {keys})),
d3 AS (SELECT d2.*, w - a1 * w1 - a2 * w2 AS e FROM d2 JOIN st1 USING ({keys})),
d4 AS (SELECT *, lag(e) OVER o AS e1 FROM d3 {w}),
st2 AS (
  SELECT {keys}, {phi} AS phi, greatest(least({theta}, 0.99e0), -0.99e0) AS theta FROM (
    SELECT {keys}, sum(w1 * w1) AS t11, sum(w1 * e1) AS t12, sum(e1 * e1) AS t22, sum(w * w1) AS t01, sum(w * e1) AS t02
    FROM d4 WHERE e1 IS NOT NULL GROUP BY {keys})),
hr AS (
  SELECT {keys}, count(*) AS n, any_value(phi) AS phi, any_value(theta) AS theta,
         sum((w - phi * w1 - theta * e1) ** 2) AS sse, count(e1) AS used,
         arg_max(y, ano * 100 + mes) AS y0, arg_max(phi * w + theta * e, ano * 100 + mes) AS step
  FROM d4 JOIN st2 USING ({keys}) GROUP BY {keys}),
ar AS (
  SELECT {keys}, CAST(i AS INTEGER) AS periodo, {r('y0 + step * (1 - phi ** i) / (1 - phi)', 4)} AS valor_previsto,
         'arima_hr' AS modelo
  FROM hr, (SELECT unnest(range(1, 7)) AS i) WHERE n >= 8 AND abs(phi) < 1)"""


ORACLE["pred_aic"] = f"""WITH {STAR}, {KEYED}, {arima(K2)}
SELECT {K2}, n, {r('phi', 5)} AS phi, {r('theta', 5)} AS theta,
       CASE WHEN n >= 8 AND abs(phi) < 1 THEN {r('used * ln(sse / used) + 6', 4)} END AS aic FROM hr"""


def moving_average(periods: int) -> str:
    return f"""ma AS (
  SELECT {K2}, row_number() OVER o AS pos, count(*) OVER (PARTITION BY {K2}) AS n, avg(y) OVER (PARTITION BY {K2}) AS geral,
         CASE WHEN row_number() OVER o >= 3 THEN avg(y) OVER (o ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) END AS media
  FROM m WINDOW o AS (PARTITION BY {K2} ORDER BY ano, mes)),
one AS (SELECT {K2}, n, any_value(geral) AS geral FROM ma GROUP BY ALL)
SELECT one.tipo_veiculo, one.sk_estado, CAST(i AS INTEGER) AS periodo,
       {r(f'CASE WHEN one.n >= {periods} THEN media ELSE one.geral END', 4)} AS valor_previsto, 'media_movel_3m' AS modelo
FROM one JOIN (SELECT unnest(range(1, {periods + 1})) AS i) ON true
LEFT JOIN ma ON one.tipo_veiculo = ma.tipo_veiculo AND one.sk_estado = ma.sk_estado AND pos = one.n - {periods} + i"""


ORACLE["pred_moving_average"] = f"WITH {STAR}, {KEYED}, {moving_average(6)}"
ORACLE["pred_moving_average_short"] = f"WITH {STAR}, {KEYED.replace(f'FROM {F_V} GROUP', f'FROM {F_V} WHERE ano = 1995 GROUP')}, {moving_average(18)}"

AVERAGES, AVERAGE_ROWS = moving_average(6).rsplit("\nSELECT", 1)
AVERAGE_ROWS = f"SELECT{AVERAGE_ROWS}"


def every_series(series: str) -> str:
    """ARIMA where it fits, else the moving average, and why."""
    return f"""WITH {STAR}, {series}, {arima(K2)}, {AVERAGES}, mv AS ({AVERAGE_ROWS}),
why AS (
  SELECT {K2}, CASE WHEN count(*) < 8 THEN 'poucos_meses' WHEN any_value(phi) IS NULL OR any_value(theta) IS NULL THEN 'singular'
    WHEN abs(any_value(phi)) < 1 THEN 'ajustado' ELSE 'instavel' END AS motivo
  FROM m LEFT JOIN st2 USING ({K2}) GROUP BY {K2})
SELECT *, 'ajustado' AS motivo FROM ar UNION ALL
SELECT mv.*, motivo FROM mv JOIN why USING ({K2}) WHERE motivo <> 'ajustado'"""


ORACLE["pred_arima"] = every_series(KEYED)
PLANTED = KEYED.replace("m AS (", "real AS (") + """,
m AS (
  SELECT tipo_veiculo, sk_estado, ano, mes, y FROM real UNION ALL
  SELECT tipo_veiculo, CAST(-1 - sk_estado AS INTEGER), ano, mes,
         CASE sk_estado % 5 WHEN 1 THEN 2e0 WHEN 2 THEN power(1.2e0, idx) + idx * 7 % 5 / 10e0 ELSE y END
  FROM real WHERE sk_estado % 5 = 0 AND ano * 100 + mes < 199507 OR sk_estado % 5 IN (1, 2))"""
ORACLE["pred_series_forecast"] = every_series(PLANTED)
ORACLE["pred_forecast_counts"] = f"""WITH {STAR}, {KEYED}, n AS (SELECT count(DISTINCT (tipo_veiculo, sk_estado)) AS n FROM m)
SELECT 'fim' AS tabela, n FROM n UNION ALL SELECT 'previsao', n FROM n"""

LINES = """pos AS (SELECT *, CAST(row_number() OVER (PARTITION BY tipo_veiculo ORDER BY ano, mes) - 1 AS DOUBLE) AS x FROM m),
line AS (
  SELECT tipo_veiculo, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, arg_max(y, x) AS ultimo, count(*) AS n
  FROM pos GROUP BY tipo_veiculo HAVING count(*) >= 3)"""
TREND_LABEL = "CASE WHEN a > 0 THEN 'CRESCENTE' ELSE 'DECRESCENTE' END AS tendencia"
PROJECTION = f"{r('a * (n + 6) + b', 4)} AS custo_projecao_6m"
ORACLE["pred_trend_by_type"] = f"""WITH {STAR}, {BY_TYPE}, {LINES}
SELECT tipo_veiculo, {TREND_LABEL}, {r('a', 6)} AS "inclinação", {r('ultimo', 4)} AS custo_atual, {PROJECTION} FROM line"""
ORACLE["dash_g16"] = f"""WITH {STAR}, {BY_TYPE}, {LINES}
SELECT tipo_veiculo, {TREND_LABEL}, {r('ultimo', 4)} AS custo_atual, {PROJECTION} FROM line"""
FLEET_FORECAST = f"{TOTAL}, {regression('serie')}, {regression_forecast('serie', 500_000, 1_800_000)}"
ORACLE["dash_g15"] = f"""WITH {STAR}, {FLEET_FORECAST}
SELECT 'Historico' AS serie, ano, mes, {MONTHS}[mes] || '/' || CAST(ano AS VARCHAR) AS label, {avg('cpk', 4, 4)} AS custo_km
FROM f GROUP BY ano, mes
UNION ALL
SELECT 'Previsao', ano, mes, CAST(mes AS VARCHAR) || '/' || CAST(ano AS VARCHAR), custo_por_km_previsto FROM prev"""
ORACLE["pred_pipeline"] = f"""WITH {STAR}, {FLEET_FORECAST}, {arima('serie')},
mt AS (SELECT tipo_veiculo, ano, mes, {FIELDS} FROM {F_V} GROUP BY ALL), {LINES.replace('FROM m)', 'FROM mt)')}
SELECT 'regressao' AS tabela, CAST(mes AS VARCHAR) || '/' || CAST(ano AS VARCHAR) AS chave, custo_por_km_previsto AS valor FROM prev
UNION ALL SELECT 'serie', CAST(periodo AS VARCHAR), valor_previsto FROM ar
UNION ALL SELECT 'tendencia', tipo_veiculo || ' ' || CASE WHEN a > 0 THEN 'CRESCENTE' ELSE 'DECRESCENTE' END,
       {r('a * (n + 6) + b', 4)} FROM line"""
