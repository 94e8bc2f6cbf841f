"""Column layouts of the supported input files. The names, types and order of the files' columns."""

from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


FRIENDS = _schema(
    ("id", T.IntegerType()),
    ("name", T.StringType()),
    ("age", T.IntegerType()),
    ("friends", T.IntegerType()),
)
RATINGS = _schema(
    ("user_id", T.IntegerType()),
    ("movie_id", T.IntegerType()),
    ("rating", T.IntegerType()),
    ("timestamp", T.LongType()),
)
RATINGS_FRACTIONAL = _schema(
    ("user_id", T.IntegerType()),
    ("movie_id", T.IntegerType()),
    ("rating", T.DoubleType()),
    ("timestamp", T.LongType()),
)
TITLES = _schema(("movie_id", T.IntegerType()), ("title", T.StringType()))
WEATHER = _schema(
    ("station_id", T.StringType()),
    ("date", T.IntegerType()),
    ("measure_type", T.StringType()),
    ("temperature", T.FloatType()),
)
ORDERS = _schema(
    ("customer_id", T.IntegerType()),
    ("item_id", T.IntegerType()),
    ("amount_spent", T.FloatType()),
)
NAMES = _schema(("id", T.LongType()), ("name", T.StringType()))
REGRESSION = _schema(("label", T.DoubleType()), ("feature", T.DoubleType()))
