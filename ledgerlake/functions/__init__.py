from ledgerlake.functions.documents import cnpj_is_valid, cpf_is_valid, normalize_cep
from ledgerlake.functions.keys import assert_key, fill_uuid5, first_id, uuid5_key, uuid_text
from ledgerlake.functions.text import (
    any_of,
    blank_to_null,
    drop_falsy_json,
    enum_name,
    flag,
    iso_second,
    keep_values,
    lower_text,
    rename_values,
    text,
    upper_text,
    zero_to_null,
)

__all__ = [
    "any_of",
    "assert_key",
    "blank_to_null",
    "cnpj_is_valid",
    "cpf_is_valid",
    "drop_falsy_json",
    "enum_name",
    "fill_uuid5",
    "first_id",
    "flag",
    "iso_second",
    "keep_values",
    "lower_text",
    "normalize_cep",
    "rename_values",
    "text",
    "upper_text",
    "uuid5_key",
    "uuid_text",
    "zero_to_null",
]
