"""Record layouts and the constants that fix the results."""

from __future__ import annotations

from pyspark.sql import types as T

# The fields of an item line, in file order.
ITEM_COLUMNS = (
    "mid", "name", "descri", "timelong", "issue", "shoot", "language", "genres", "actors", "directors",
)

MOVIE = T.StructType(
    [T.StructField("mid", T.IntegerType())]
    + [T.StructField(name, T.StringType()) for name in ITEM_COLUMNS[1:]]
)
RATING = T.StructType(
    [
        T.StructField("uid", T.IntegerType()),
        T.StructField("mid", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ts", T.LongType()),
    ]
)
TAG = T.StructType(
    [
        T.StructField("uid", T.IntegerType()),
        T.StructField("mid", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)
USER = T.StructType(
    [
        T.StructField("uid", T.LongType()),
        T.StructField("username", T.StringType()),
        T.StructField("first", T.BooleanType()),
        T.StructField("ts", T.LongType()),
        T.StructField("prefGenres", T.ArrayType(T.StringType())),
    ]
)

# Category names, log format, topics, list lengths, cuts and weights.
CATEGORIES = (
    "Action", "Adventure", "Animation", "Comedy", "Crime", "Documentary", "Drama", "Family",
    "Fantasy", "Foreign", "History", "Horror", "Music", "Mystery", "Romance", "Science", "Tv",
    "Thriller", "War", "Western",
)
LOG_PREFIX = "MOVIE_RATING_PREFIX:"
LOG_TOPIC, RATING_TOPIC, FORWARD_KEY = "log", "recommender", "logProcessor"
CATEGORY_LIST_LENGTH = 10
USER_LIST_LENGTH = 20
RECENT_RATINGS = 20
CANDIDATES = 20
QUEUE_LENGTH = 40
MIN_SIMILARITY = 0.6
SCORING_GATE = 0.7
LIKED_ABOVE = 3.0
HASH_BUCKETS = 50
ALS_RANK, ALS_ITERATIONS, ALS_LAMBDA = 200, 5, 0.1
TUNING_RANKS = (50, 100, 200, 300)
TUNING_LAMBDAS = (0.01, 0.1, 1.0)
HYBRID_WEIGHTS = (0.3, 0.3, 0.4)
STREAM_INTERVAL = "2 seconds"
BM25_K1, BM25_B = 1.2, 0.75
MORE_LIKE_THIS_TERMS = 25

# Scores are rounded to this many digits before they are compared or ordered, so that the
# summation order of partial results never decides a cut or a tie.
SCORE_DIGITS = 12
