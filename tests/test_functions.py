import uuid

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlake import functions as L


def column(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_text_idioms(spark):
    given = [" a ", "  ", "", None, "\t"]
    assert column(spark, given, L.text("x")) == ["a", None, None, None, "\t"]
    assert column(spark, given, L.blank_to_null("x")) == [" a ", None, None, None, None]


def test_flags_are_two_valued_and_enums_three_valued(spark):
    given = ["acquitted", "PENDING", None]
    assert column(spark, given, L.any_of("x", "ACQUITTED")) == [True, False, False]
    assert column(spark, [" ATIVO", "x", None], L.keep_values("x", "ativo")) == ["ativo", None, None]
    kinds = {"fisica": "pf", "física": "pf", "juridica": "pj"}
    assert column(spark, ["FÍSICA ", "Juridica", "?"], L.rename_values("x", kinds)) == ["pf", "pj", None]


def test_enum_objects_and_empty_json(spark):
    assert column(spark, ['{"nome":"A"}', "B", '{"x":1}', None], L.enum_name("x")) == ["A", "B", '{"x":1}', None]
    given = ["{}", " [ ] ", "null", "0", '{"a":0}', None]
    assert column(spark, given, L.drop_falsy_json("x")) == [None, None, None, None, '{"a":0}', None]


def test_iso_second(spark):
    given = ["2026-04-18T14:26:00.728", "2026-04-18T14:26:00Z", "2026-04-18T14:26:00.1-03:00", "2026-04-18T14:26:00"]
    assert set(column(spark, given, L.iso_second("x"))) == {"2026-04-18T14:26:00"}


def test_uuid_text(spark):
    good = "6BA7B812-9DAD-11D1-80B4-00C04FD430C8"
    assert column(spark, [good, None], L.uuid_text("x")) == [good.lower(), None]
    assert column(spark, ["nope"], L.uuid_text("x", strict=False)) == [None]
    with pytest.raises(Exception, match="not a UUID"):
        column(spark, ["nope"], L.uuid_text("x"))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=30))
def test_uuid5_equals_the_standard_one(spark, names):
    got = column(spark, names, L.uuid5_key(F.lit("kind"), "x"))
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_OID, f"kind|{n}")) for n in names]


def cpf(body):
    digits = [int(d) for d in body]
    for weights in (range(10, 1, -1), range(11, 1, -1)):
        rest = sum(d * w for d, w in zip(digits, weights, strict=True)) % 11
        digits.append(0 if rest < 2 else 11 - rest)
    return "".join(map(str, digits))


def test_person_numbers(spark):
    good = [cpf(f"{n:09d}") for n in (123456789, 529982247, 7, 999999998)]
    bad = [g[:-1] + str((int(g[-1]) + 1) % 10) for g in good] + ["11111111111", "123", "", "abc"]
    assert column(spark, good, L.cpf_is_valid("x")) == [True] * len(good)
    assert column(spark, bad, L.cpf_is_valid("x")) == [False] * len(bad)
    assert column(spark, [None, "529.982.247-25"], L.cpf_is_valid("x")) == [None, True]


def test_company_numbers(spark):
    given = ["11.222.333/0001-81", "11222333000181", "11222333000182", "00000000000000", None]
    assert column(spark, given, L.cnpj_is_valid("x")) == [True, True, False, False, None]


def test_postal_codes(spark):
    assert column(spark, ["01310-100", "0131010", " ", None], L.normalize_cep("x")) == ["01310100", None, None, None]


def test_ids_of_a_column_are_filled_where_empty(spark):
    df = spark.createDataFrame([("own", "a"), ("", "é"), (None, None)], "id string, x string")
    got = [r["id"] for r in L.fill_uuid5(df, "id", F.lit("kind"), "x").collect()]
    assert got == ["own", str(uuid.uuid5(uuid.NAMESPACE_OID, "kind|é")), str(uuid.uuid5(uuid.NAMESPACE_OID, "kind"))]
