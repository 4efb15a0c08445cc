from tabulon.functions.columns import (  # noqa: F401
    fields_of_line,
    hash_unit,
    items_of_line,
    path_part,
    prefix_label,
    squared_error,
    token_count,
    token_count_udf,
)
