"""Names, limits, texts and lookup tables that results must carry as they are."""

# Federal units by region.
REGIONS = {
    "NORTE": ["RO", "AC", "AM", "RR", "PA", "AP", "TO"],
    "NORDESTE": ["MA", "PI", "CE", "RN", "PB", "PE", "AL", "SE", "BA"],
    "SUDESTE": ["MG", "ES", "RJ", "SP"],
    "SUL": ["PR", "SC", "RS"],
    "CENTRO OESTE": ["MS", "MT", "GO", "DF"],
}
UNKNOWN_REGION = "DESCONHECIDO"

# Month names.
MONTH_NAMES = ["Jan", "Fev", "Mar", "Abr", "Mai", "Jun", "Jul", "Ago", "Set", "Out", "Nov", "Dez"]

# Headers of the fuel-price feed.
PRICE_HEADERS = {
    "Regiao - Sigla": "regiao",
    "Estado - Sigla": "estado",
    "Municipio": "municipio",
    "Produto": "produto",
    "Data da Coleta": "data_coleta",
    "Valor de Venda": "valor_venda",
    "Valor de Compra": "valor_compra",
    "Bandeira": "bandeira",
    "Unidade de Medida": "unidade_medida",
}

# Vehicle types counted as operational fleet.
OPERATIONAL_TYPES = [
    "AUTOMOVEL", "CAMINHAO", "CAMINHONETE", "CAMIONETA", "MICROONIBUS", "ONIBUS", "UTILITARIO",
]

# Economic indicators (name, aggregate, classification, description).
INDICATORS = [
    ("IPCA", "7060", "315|7169", "Indice Nacional de Precos ao Consumidor Amplo"),
    ("PIB", "6784", "1|1", "Produto Interno Bruto a precos correntes"),
    ("SALARIO", "5938", "1|1", "Rendimento medio mensal"),
    ("POPULACAO", "6579", "1|1", "Projecao da populacao"),
]

# KPI limits (critical, attention, which side is worse).
LIMITS = {
    "custo_por_km": (2.50, 1.80, "higher"),
    "margem_operacional": (0.10, 0.20, "lower"),
    "disponibilidade_pct": (75.0, 85.0, "lower"),
    "km_por_litro_real": (3.0, 4.5, "lower"),
}

# Recommended action by KPI and class.
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

# Recommendation by age range (both ends included).
AGE_ADVICE = [
    (0, 3, "Manutenção preventiva padrão - veículo no auge"),
    (4, 6, "Acompanhar custo de manutenção - planejar reserva"),
    (7, 9, "Planejar substituição - custo tende a subir"),
    (10, 14, "Avaliar substituição imediata - custo elevado de manutenção"),
    (15, 99, "Substituir obrigatoriamente - veículo obsoleto e ineficiente"),
]
DEFAULT_ADVICE = "Verificar estado geral do veículo"

# Decision by severity (critical alerts, attention alerts, none).
DECISIONS = ["INTERVENCAO IMEDIATA", "MONITORAR E PLANEJAR", "OPERACAO NORMAL"]

# Age bands of the efficiency view and of the root-cause diagnostic.
AGE_BANDS = [(3, "Nova (0-3)"), (6, "Jovem (4-6)"), (9, "Madura (7-9)"), (14, "Antiga (10-14)")]
AGE_BAND_ABOVE = "Obsoleta (15+)"
AGE_YEARS = [(3, "0-3 anos"), (6, "4-6 anos"), (9, "7-9 anos"), (14, "10-14 anos")]
AGE_YEARS_ABOVE = "15+ anos"

# Fuel reference (fuel, maintenance cost per km, CO2 g per km).
FUEL_REFERENCE = [
    ("Diesel", "0.35", "158.0"),
    ("Flex", "0.22", "120.0"),
    ("Gasolina", "0.25", "130.0"),
    ("GNV", "0.18", "95.0"),
    ("Eletrico", "0.12", "0.0"),
    ("N/A", "0.00", "0.0"),
]

# Age reference (band, from, to, advice).
AGE_REFERENCE = [
    ("Nova", 0, 3, "Manutenção preventiva padrão"),
    ("Jovem", 4, 6, "Acompanhar custo de manutenção"),
    ("Madura", 7, 9, "Planejar substituição"),
    ("Antiga", 10, 14, "Avaliar substituição imediata"),
    ("Obsoleta", 15, 99, "Substituir obrigatoriamente"),
]

# Actions of the limit reference (KPI, when critical, when in attention); the limits are
# those of LIMITS.
LIMIT_ACTIONS = [
    ("custo_por_km", "Substituir ou revisar operação", "Monitorar e planejar manutenção"),
    ("margem_operacional", "Rever rota e composição de custos", "Otimizar custos operacionais"),
    ("disponibilidade_pct", "Frota com baixa disponibilidade", "Verificar manutenção preventiva"),
    ("km_por_litro_real", "Verificar consumo anômalo", "Monitorar eficiência do veículo"),
]
