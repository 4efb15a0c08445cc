from tabulon.sources.readers import (  # noqa: F401
    MOVIE_SCHEMA,
    RATING_SCHEMA,
    read_csv,
    read_documents,
    read_lines,
    read_libsvm,
    read_table,
    run_sql,
    string_schema,
)
from tabulon.sources.writers import (  # noqa: F401
    load_pipeline,
    save_model,
    write_csv,
    write_libsvm,
    write_lines,
)
