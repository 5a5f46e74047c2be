"""Column names and schemas of the recommendation tables."""

from pyspark.sql import types as T

# The column names of the public click-log layout these tables use.
IMPRESSION_ID = "impression_id"
IMPRESSION_TIME = "impression_time"
USER_ID = "user_id"
INVIEW = "article_ids_inview"
CLICKED = "article_ids_clicked"
LABELS = "labels"
SCORES = "scores"
KNOWN_USER = "is_known_user"
N_SAMPLES = "n_samples"
HISTORY = "article_id_fixed"
ARTICLE_ID = "article_id"
TITLE = "title"
SUBTITLE = "subtitle"
CATEGORY = "category"

TRAIN_COLUMNS = [USER_ID, HISTORY, INVIEW, CLICKED, IMPRESSION_ID]
TEST_COLUMNS = [USER_ID, HISTORY, INVIEW, IMPRESSION_ID]

_ids = T.ArrayType(T.LongType())

BEHAVIORS_SCHEMA = T.StructType(
    [
        T.StructField(IMPRESSION_ID, T.LongType()),
        T.StructField(USER_ID, T.LongType()),
        T.StructField(IMPRESSION_TIME, T.TimestampNTZType()),
        T.StructField(INVIEW, _ids),
        T.StructField(CLICKED, _ids),
    ]
)

HISTORY_SCHEMA = T.StructType(
    [T.StructField(USER_ID, T.LongType()), T.StructField(HISTORY, _ids)]
)

ARTICLES_SCHEMA = T.StructType(
    [
        T.StructField(ARTICLE_ID, T.LongType()),
        T.StructField(TITLE, T.StringType()),
        T.StructField(SUBTITLE, T.StringType()),
        T.StructField(CATEGORY, T.StringType()),
    ]
)


def check_columns(df, columns):
    """Raise ValueError naming every column of ``columns`` that ``df`` lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"The DataFrame has no columns {missing}; it has {df.columns}.")
