import contextlib
import io
from datetime import datetime

TS = datetime(2024, 1, 10, 3, 0)


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


def values(df, *columns):
    """Rows as sorted tuples; NULLs sort first."""
    rows = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: [(v is not None, v) for v in row])


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@contextlib.contextmanager
def settings(spark, **changed):
    names = {name.replace("__", "."): value for name, value in changed.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
