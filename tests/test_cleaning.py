import datetime as dt
from decimal import Decimal

from fleetspark.operators import cleaning
from fleetspark.schemas import INDICATORS_RAW, OPERATIONS_RAW, PRICES_RAW

from .conftest import rows

PRICE_ROW = ("norte", " sp\t", "Porto Velho", "gasolina ", "01/03/2024", "5.62", "4.78", "BRANCA", "R$/l")


def price(**changes):
    names = ["regiao", "estado", "municipio", "produto", "data", "venda", "compra", "bandeira", "unidade"]
    return tuple(changes.get(n, v) for n, v in zip(names, PRICE_ROW))


def test_prices(spark):
    raw = spark.createDataFrame(
        [
            price(), price(),  # a copy
            price(venda="abc"), price(venda=""), price(venda="nan"), price(venda=None),  # no usable price
            price(data="2024-03-01"), price(data="31/02/2024"), price(compra="x"),
            price(estado=" rj　", data="1/12/2023"), price(estado=None),
        ],
        PRICES_RAW,
    )
    clean = cleaning.clean_prices(raw)
    assert clean.count() == 6
    first = clean.filter("data_coleta = DATE'2024-03-01' AND valor_compra IS NOT NULL AND estado = 'SP'").first()
    assert (first.regiao, first.produto, first.valor_venda) == ("NORTE", "GASOLINA", Decimal("5.6200"))
    assert (first.ano, first.mes) == (2024, 3)
    assert clean.filter("data_coleta IS NULL").count() == 2
    assert clean.filter("estado = 'RJ'").first().data_coleta == dt.date(2023, 12, 1)
    assert clean.filter("valor_compra IS NULL").count() == 1


def test_keep_first_by_key_keeps_the_whole_first_row(spark):
    df = spark.createDataFrame(
        [("V1", "later", None, 9), ("V1", None, "first", 1), ("V2", "only", "x", 5)],
        "veiculo_id string, marca string, status string, _ordem int",
    )
    kept = cleaning.keep_first_by_key(df, ["veiculo_id"], "_ordem")
    assert rows(kept) == [(1, None, "first", "V1"), (5, "only", "x", "V2")]


def test_indicators(spark):
    raw = spark.createDataFrame(
        [(" ipca ", "d", "2023", "4.62", "sp "), (" ipca ", "d", "2023", "4.62", "sp "),
         ("IPCA", "d", "202301", "...", "SP"), ("pib", "d", "2022", "1e3", "\trj")],
        INDICATORS_RAW,
    )
    got = {(r.indicador, r.periodo, float(r.valor), r.estado) for r in cleaning.clean_indicators(raw).collect()}
    assert got == {("IPCA", "2023", 4.62, "SP"), ("PIB", "2022", 1000.0, "RJ")}
    national = cleaning.clean_indicators(raw.drop("estado"))
    assert "estado" not in national.columns and national.count() == 2


def test_operations_fill_zero(spark):
    row = ("V1", "Pickup", " sp", 2024, 1, None, Decimal("1.00"), None, "10.5", "bad", "", None, "1", "2",
           3, Decimal("90.0"))
    raw = spark.createDataFrame([row, row], OPERATIONS_RAW)
    clean = cleaning.clean_operations(raw).collect()
    assert len(clean) == 1
    r = clean[0]
    assert (r.estado, r.km_rodado, r.preco_combustivel) == ("SP", 0, 0)
    assert (r.custo_combustivel, r.custo_manutencao, r.custo_seguro) == (Decimal("10.50"), 0, 0)
