"""Logical tables built from the benchmark's parquet files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingloom.functions.scalars import wall_seconds
from ratingloom.session import dealt, parts_for
from ratingloom.sources.sinks import rating_log_line

# The name words of the part table, used as categories, and the preferences of users.
NAME_WORDS = (
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "old", "plate", "red", "ring", "rod", "small", "widget",
)
PREFERENCES = ("small", "red", "blue", "old", "hot", "new", "cold", "large")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rating_parts(spark: SparkSession, sf_dir: str) -> int | None:
    """The partitions for the rows of ``rating``; see ``parts_for``."""
    return parts_for(spark, read(spark, sf_dir, "lineitem").count())


def rating(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, mid, score, ts, ok, ln): who ordered what, the quantity as half stars."""
    parts = rating_parts(spark, sf_dir)
    items = read(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").cast("int").alias("mid"),
        (F.ceil(F.col("l_quantity") / 5) / 2).alias("score"),
        wall_seconds("l_shipdate").alias("ts"),
        F.col("l_orderkey").alias("ok"),
        F.col("l_linenumber").alias("ln"),
    )
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ok"), F.col("o_custkey").cast("int").alias("uid"))
    return dealt(items, parts, "ok").join(dealt(orders, parts, "ok"), "ok").select("uid", "mid", "score", "ts", "ok", "ln")


def movie(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") * 37 % 2500).cast("int"))
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("mid"),
        F.col("p_name").alias("name"),
        F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("descri"),
        F.concat_ws("|", F.translate("p_name", " ", "|"), "p_type").alias("genres"),
        F.date_format(day, "MMMM d, yyyy").alias("issue"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("int").alias("uid"),
        F.get_json_object("props", "$.k").cast("int").alias("mid"),
        "event_type",
        (F.least(F.lit(10), 1 + F.floor(F.col("value") / 15)).cast("double") / 2).alias("score"),
        wall_seconds("ts").alias("ts"),
        "props",
    )


def tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select("uid", "mid", F.col("event_type").alias("tag"), "ts")


def _rated() -> Column:
    return F.col("event_type").isin("purchase", "view")


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).where(_rated()).select("event_id", "uid", "mid", "score", "ts")


def log_line(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    other = F.concat(F.col("event_type"), F.lit(" "), F.col("props"))
    text = F.concat(F.lit("INFO x - "), F.when(_rated(), rating_log_line()).otherwise(other))
    return _events(spark, sf_dir).select(text.alias("value"), *keep)


def user_pref(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = (F.col("c_custkey") % len(PREFERENCES)).cast("int")
    choice = F.get(F.array(*[F.lit(p) for p in PREFERENCES]), slot)
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("uid"), F.col("c_name").alias("username"), F.array(choice).alias("prefGenres")
    )


def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_pref(spark, sf_dir).select(
        F.col("uid").cast("long").alias("uid"), "username", F.lit(True).alias("first"), F.lit(0).cast("long").alias("ts"), "prefGenres"
    )


def _vectors(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias(key), F.col("embedding").alias("features"))


def item_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir, "mid")


def item_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir, "mid")


def user_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vectors(spark, sf_dir, "uid")


# The same tables in DuckDB SQL, for the oracle.
SQL_TABLES = {
    "rating": """select cast(o_custkey as int) uid, cast(l_partkey as int) mid, ceil(l_quantity/5)/2 score,
        cast(epoch(l_shipdate) as bigint) ts, l_orderkey ok, l_linenumber ln
        from lineitem join orders on l_orderkey = o_orderkey""",
    "movie": """select cast(p_partkey as int) mid, p_name as name, p_name || ' ' || p_type || ' ' || p_brand descri,
        replace(p_name, ' ', '|') || '|' || p_type genres,
        strftime(date '1995-01-01' + cast(p_partkey * 37 % 2500 as int), '%B %-d, %Y') issue from part""",
    "ev": """select event_id, cast(user_id as int) uid, cast(json_extract_string(props, '$.k') as int) mid, event_type,
        cast(least(10, 1 + floor(value / 15)) as double) / 2 score, cast(floor(epoch(ts)) as bigint) ts, props from events""",
    "tag": "select uid, mid, event_type tag, ts from ev",
    "live": "select event_id, uid, mid, score, ts from ev where event_type in ('purchase', 'view')",
    "log_line": """select 'INFO x - ' || case when event_type in ('purchase', 'view')
        then 'MOVIE_RATING_PREFIX:' || uid || '|' || mid || '|' || score || '|' || ts
        else event_type || ' ' || props end as value from ev""",
    "user_pref": f"""select cast(c_custkey as int) uid, c_name username,
        [({list(PREFERENCES)!r})[c_custkey % {len(PREFERENCES)} + 1]] prefGenres from customer""",
    "item_vec": "select cast(vec_id as int) mid, cast(embedding as double[]) features from embeddings",
    "user_vec": "select cast(vec_id as int) uid, cast(embedding as double[]) features from embeddings",
    "avg_score": "select mid, avg(score) as avg from rating group by mid",
    "monthly": """select mid, count(*) num, year(to_timestamp(ts) at time zone 'UTC') * 100
        + month(to_timestamp(ts) at time zone 'UTC') yearmonth from rating group by all""",
    "genre_hits": "select c.g genres, m.mid, a.avg from movie m join avg_score a using (mid), "
    + f"(select unnest({list(NAME_WORDS)!r}) g) c where contains(lower(m.genres), lower(c.g))",
    "genre_list": """select * from (select genres, row_number() over (partition by genres order by avg desc, mid) as rank,
        mid, avg from genre_hits) where rank <= 10""",
    "pair_sim": """select a.mid, b.mid sim_mid, round(list_dot_product(a.features, b.features) /
        (sqrt(list_dot_product(a.features, a.features)) * sqrt(list_dot_product(b.features, b.features))), 12) score
        from item_vec a join item_vec b on a.mid <> b.mid""",
    "corpus": """select m.*, t.tags from movie m left join
        (select mid, string_agg(distinct tag, '|' order by tag) tags from tag group by mid) t using (mid)""",
    "cf_all": """select u.uid, i.mid, round(list_dot_product(u.features, i.features), 12) score
        from user_vec u, item_vec i where list_dot_product(u.features, i.features) > 0""",
    "user_list": """select * from (select uid, mid, score,
        row_number() over (partition by uid order by score desc, mid) as rank from cf_all) where rank <= 20""",
    "bag": "select mid, list_sort(string_split(lower(replace(genres, '|', ' ')), ' ')) words from movie",
    "term_tf": "select mid, term, count(*) tf from (select mid, unnest(words) term from bag) group by all",
    "term_w": """select t.mid, t.term, t.tf * ln(((select count(*) from movie) + 1) / (d.df + 1)) weight
        from term_tf t join (select term, count(*) df from term_tf group by term) d using (term)""",
    "content_pair": """select a.mid, b.mid sim_mid, round(sum(a.weight * b.weight) / (any_value(na.n) * any_value(nb.n)), 12) score
        from term_w a join term_w b on a.term = b.term and a.mid <> b.mid
        join (select mid, sqrt(sum(weight * weight)) n from term_w group by mid) na on na.mid = a.mid
        join (select mid, sqrt(sum(weight * weight)) n from term_w group by mid) nb on nb.mid = b.mid
        group by a.mid, b.mid""",
    "sim": "select * from pair_sim where score > 0.15",
    "latest": """select uid, mid from (select *, row_number() over (partition by uid order by ts desc, mid desc, score desc) r
        from live) where r = 1""",
    "recent": """select * from (select uid, mid, score, row_number() over
        (partition by uid order by ts desc, mid desc, score desc) pos from live) where pos <= 20""",
    "cand": """select * from (select l.uid, s.sim_mid mid, s.score, row_number() over
        (partition by l.uid order by s.score desc, s.sim_mid) as rank from latest l join sim s on s.mid = l.mid
        where not exists (select 1 from live x where x.uid = l.uid and x.mid = s.sim_mid)) where rank <= 20""",
    "cand_pair": """select c.uid, c.mid, r.pos, r.mid recent_mid, r.score recent_score, coalesce(s.score, 0) sim
        from cand c join recent r on c.uid = r.uid left join sim s on s.mid = c.mid and s.sim_mid = r.mid""",
    "scored": """select uid, mid, avg(sim * recent_score) + log10(greatest(1, count(*) filter (recent_score > 3)))
        - log10(greatest(1, count(*) filter (recent_score <= 3))) score from cand_pair where sim > 0.2 group by uid, mid""",
    "live_list": """select uid, mid, score, row_number() over (partition by uid order by round(score, 12) desc, mid) as rank
        from scored""",
}

_NEEDS = {
    "tag": ("ev",),
    "live": ("ev",),
    "log_line": ("ev",),
    "avg_score": ("rating",),
    "monthly": ("rating",),
    "genre_hits": ("movie", "avg_score"),
    "genre_list": ("genre_hits",),
    "pair_sim": ("item_vec",),
    "corpus": ("movie", "tag"),
    "cf_all": ("user_vec", "item_vec"),
    "user_list": ("cf_all",),
    "bag": ("movie",),
    "term_tf": ("bag",),
    "term_w": ("term_tf", "movie"),
    "content_pair": ("term_w",),
    "sim": ("pair_sim",),
    "latest": ("live",),
    "recent": ("live",),
    "cand": ("latest", "sim", "live"),
    "cand_pair": ("cand", "recent", "sim"),
    "scored": ("cand_pair",),
    "live_list": ("scored",),
}


def _ordered(names: tuple[str, ...]) -> list[str]:
    def add(done: list[str], name: str) -> list[str]:
        if name in done:
            return done
        return [*reduce(add, _NEEDS.get(name, ()), done), name]

    return reduce(add, names, [])


def sql(body: str, *tables: str) -> str:
    """``body`` after the definitions of the ``tables`` it reads and of what those need."""
    parts = [f"{name} as ({SQL_TABLES[name]})" for name in _ordered(tables)]
    return "with " + ",\n".join(parts) + "\n" + body
