from bibflow.functions.json import as_array, json_or_empty, json_or_null, parse, render, with_elements
from bibflow.functions.scalars import (
    concat_date_parts,
    flag_as_int,
    flag_normalize,
    null_struct,
    safe_date,
    safe_int,
    typed_null,
)

__all__ = [
    "as_array", "json_or_empty", "json_or_null", "parse", "render", "with_elements",
    "concat_date_parts", "flag_as_int", "flag_normalize", "null_struct",
    "safe_date", "safe_int", "typed_null",
]
