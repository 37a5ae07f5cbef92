from pyspark.sql import types as T

from lastro import contracts
from lastro import fixed_values as fv


def test_column_roles_are_disjoint():
    assert contracts.overlapping_roles() == set()
    assert not set(contracts.LEAKY) & set(contracts.SAFE_FEATURES)


def test_feature_counts():
    assert len(contracts.NUMERIC_FEATURES) == 20
    assert len(contracts.CATEGORICAL_FEATURES) == 5
    assert len(contracts.PAYMENTS) == 10 and len(contracts.AUXILIARY) == 11
    assert len(fv.CNAE_DIVISIONS) == 87 and len(fv.STATES) == 27


def test_null_rate_thresholds():
    def limit(contract, column):
        return round(contract[column].null_rate_threshold(), 4)

    assert limit(contracts.PAYMENTS, "dt_pagamento") == 0.0598
    assert limit(contracts.PAYMENTS, "vlr_baixa") == 0.2304
    assert limit(contracts.AUXILIARY, "cedente_indice_liquidez_1m") == 0.9318


def test_contract_as_schema():
    schema = contracts.struct_type(contracts.PAYMENTS)
    assert schema["dt_emissao"].dataType == T.DateType()
    assert not schema["id_boleto"].nullable and schema["id_boleto"].metadata["unique"]
    assert schema["tipo_especie"].metadata["allowed"] == list(fv.INSTRUMENT_LABELS)
    assert contracts.columns_of(contracts.PAYMENTS, T.DateType) == [
        "dt_emissao", "dt_vencimento", "dt_pagamento"
    ]
    assert contracts.columns_of(contracts.PAYMENTS, T.DoubleType) == ["vlr_nominal", "vlr_baixa"]
