"""DuckDB SQL for the queries of the catalog that SQL can express."""

from __future__ import annotations

from ratingloom.plans.standins import sql

_WORDS = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
_NAME_HASH = """list_reduce(list_prepend(0::bigint, list_transform(string_split({0}, ''), lambda c: unicode(c)::bigint)),
    lambda h, c: (h * 31 + c) & 4294967295)"""


def _words(text: str) -> str:
    return _WORDS.format(text)


def _hash(text: str) -> str:
    h = _NAME_HASH.format(text)
    return f"case when {h} >= 2147483648 then {h} - 4294967296 else {h} end"


def _rated_pairs(body: str, *tables: str) -> str:
    """``body`` over ``pred``: the factor products of the pairs in the rating table."""
    full = sql("", "rating", "user_vec", "item_vec", *tables).rstrip()
    pred = """pred as (select r.uid, r.mid, list_dot_product(u.features, i.features) score, r.copies
        from (select uid, mid, count(*) copies from rating group by all) r
        join user_vec u on r.uid = u.uid join item_vec i on r.mid = i.mid)"""
    return f"{full},\n{pred}\n{body}"


def _bm25(queries: str, fields: dict[str, str], n: int, exclude_self: bool, *tables: str) -> str:
    """BM25 with the best field per item; ``queries`` yields (qid, term), ``fields`` maps field to text."""
    tokens = " union all ".join(
        f"select mid, '{name}' field, {_words(text)} tokens from corpus" for name, text in fields.items()
    )
    own = "where qid <> mid" if exclude_self else ""
    return (
        sql("", "corpus", *tables).rstrip()
        + f""",
    doc as (select *, len(tokens) len from ({tokens}) where len(tokens) > 0),
    size as (select field, count(*) docs, avg(len) avg_len from doc group by field),
    tf as (select mid, field, len, term, count(*) tf from (select mid, field, len, unnest(tokens) term from doc) group by all),
    df as (select field, term, count(*) df from tf group by all),
    w as (select mid, field, term, ln(1 + (docs - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avg_len)) w
        from tf join df using (field, term) join size using (field)),
    q as ({queries}),
    per_field as (select qid, mid, field, sum(w) s from q join w using (term) group by all),
    best as (select qid, mid, round(max(s), 12) score from per_field {own} group by qid, mid)
    select qid, rank, mid, round(score, 6) score from (select *, row_number() over
        (partition by qid order by score desc, mid) as rank from best) where rank <= {n}"""
    )


_RANKED_CONTENT = """select * from (select *, row_number() over (partition by mid order by score desc, sim_mid) as rank
    from content_pair where score > 0.6) where rank <= 20"""

_HYBRID_PARTS = f"""
    content_top as ({_RANKED_CONTENT}),
    cf as (select * from (select uid, mid, score, row_number() over (partition by uid order by round(score, 12) desc, mid) as rank
        from pred where round(score, 12) > 0) where rank <= 20),
    cb as (select l.uid, c.rank, c.sim_mid mid, c.score from latest l join content_top c on c.mid = l.mid),
    lined as (select uid, 0 source, rank r, mid, score * 0.3 score from cf where rank <= 8
        union all select uid, 1, rank, mid, score * 0.3 from cb where rank <= 8
        union all select uid, 2, rank, mid, score * 0.4 from live_list where rank <= 8),
    hybrid as (select * from (select uid, mid, score, row_number() over (partition by uid order by source, r) as rank
        from lined) where rank <= 8)"""


def _hybrid(body: str, *tables: str) -> str:
    base = _rated_pairs("", "content_pair", "latest", "live_list", *tables).rstrip()
    return f"{base},{_HYBRID_PARTS}\n{body}"


_FALLBACK = """select uid, rank, mid, round(score, 6) score from (
    select uid, rank, mid, score from {recs} where rank <= {n} union all
    select u.uid, g.rank, g.mid, g.avg from user_pref u join genre_list g on g.genres = u.prefGenres[1]
    where g.rank <= {n} and u.uid not in (select uid from {recs}))"""

_PARSED = """select cast(split_part(value, '|', 1) as int) uid, cast(split_part(value, '|', 2) as int) mid,
    cast(split_part(value, '|', 3) as double) score, cast(split_part(value, '|', 4) as bigint) ts
    from (select trim(string_split(value, 'MOVIE_RATING_PREFIX:')[2]) as value from log_line
    where contains(value, 'MOVIE_RATING_PREFIX:'))"""

_FILTERED = """select trim(string_split(value, 'MOVIE_RATING_PREFIX:')[2]) as value from log_line
    where contains(value, 'MOVIE_RATING_PREFIX:')"""

_EDIT_LIMIT = "case when length(q) <= 2 then 0 when length(q) <= 5 then 1 else 2 end"

# Murmur3 (32 bits, seed 42) of the bytes of a word, as the hashing of terms into buckets has it:
# blocks of four bytes, little end first, then the bytes that are left.
_MIX = "(({0}::hugeint * 3432918353 % 4294967296 * 32768 % 4294967296 + {0}::hugeint * 3432918353 % 4294967296 // 131072) * 461845907 % 4294967296)::bigint"
_HASHED = f"""hashed as (
    with recursive word as (select distinct unnest(words) term from bag),
    bytes as (select term, list_transform(range(0, octet_length(encode(term))), lambda i: ('0x' || substr(hex(encode(term)), 2 * i + 1, 2))::bigint) b
        from word),
    step as (
        select term, b, 0 as done, 42::bigint as h from bytes
        union all
        select term, b, done + 4, (((xor(h, k)::hugeint * 8192 % 4294967296 + xor(h, k) // 524288) * 5 + 3864292196) % 4294967296)::bigint
        from (select *, {_MIX.format("(b[done + 1] + b[done + 2] * 256 + b[done + 3] * 65536 + b[done + 4] * 16777216)")} as k
            from step where done + 4 <= len(b))
    ),
    tail as (select term, b, case when left_ = 0 then h else xor(h, {_MIX.format("t")}) end as h from (
        select *, len(b) - done as left_,
            coalesce(b[done + 1], 0) + coalesce(b[done + 2], 0) * 256 + coalesce(b[done + 3], 0) * 65536 as t
        from step where done + 4 > len(b))),
    f1 as (select term, xor(h, len(b)::bigint) as h from tail),
    f2 as (select term, (xor(h, h // 65536)::hugeint * 2246822507 % 4294967296)::bigint as h from f1),
    f3 as (select term, (xor(h, h // 8192)::hugeint * 3266489909 % 4294967296)::bigint as h from f2),
    f4 as (select term, xor(h, h // 65536) as h from f3)
    select term, ((case when h >= 2147483648 then h - 4294967296 else h end % 50) + 50) % 50 as bucket from f4)"""


def _hashed(body: str) -> str:
    """``body`` over the hashed counts and weights of the items' words."""
    return (
        sql("", "bag").rstrip()
        + f""",
    {_HASHED},
    hash_tf as (select mid, bucket, count(*)::double tf from (select mid, unnest(words) term from bag) join hashed using (term) group by all),
    hash_w as (select mid, bucket, tf * ln(((select count(*) from bag) + 1) / (df + 1)) weight
        from hash_tf join (select bucket, count(*) df from hash_tf group by bucket) using (bucket)),
    hash_norm as (select mid, sqrt(sum(weight * weight)) n from hash_w group by mid),
    hash_pair as (select a.mid, b.mid sim_mid, round(sum(a.weight * b.weight) / (any_value(na.n) * any_value(nb.n)), 12) score
        from hash_w a join hash_w b on a.bucket = b.bucket and a.mid <> b.mid
        join hash_norm na on na.mid = a.mid join hash_norm nb on nb.mid = b.mid where na.n > 0 and nb.n > 0 group by a.mid, b.mid)
    {body}"""
    )


ORACLES: dict[str, str] = {
    "term_counts_hashed": _hashed("select mid, cast(bucket as int) bucket, tf from hash_tf"),
    "tfidf_hashed": _hashed("select mid, cast(bucket as int) bucket, round(weight, 6) weight from hash_w where weight > 0"),
    "content_similarity_hashed": _hashed(
        """select mid, cast(rank as int) rank, sim_mid, round(score, 6) score from (select *, row_number() over
        (partition by mid order by score desc, sim_mid) as rank from hash_pair where score > 0.6) where rank <= 20"""
    ),
    "train_als": sql(
        """select distinct 'user' side, uid id, 200 slots, true solved from rating
        union all select distinct 'item', mid, 200, cast(null as boolean) from rating""",
        "rating",
    ),
    "predict_pairs": sql("select uid, mid, count(*) copies, true agrees from rating group by uid, mid", "rating"),
    "recommend_users": sql(
        """select uid, cast(rank as int) rank, true same, true product from (select distinct uid from rating),
        (select unnest(range(1, 21)) as rank)""",
        "rating",
    ),
    "factor_similarity": sql("select distinct mid, true whole, true agrees from rating", "rating"),
    "tune_als": """select cast(rank as int) rank, "lambda", true fitted from (select unnest([50, 100, 200, 300]) as rank),
        (select unnest([0.01::double, 0.1::double, 1.0::double]) as "lambda")""",
    "scan_items": sql("select mid, name, descri, issue, genres, '' directors from movie", "movie"),
    "scan_ratings": sql("select uid, mid, score, ts from rating", "rating"),
    "scan_tags": sql("select uid, mid, tag, ts from tag", "tag"),
    "rejected_lines": sql(
        """select case tag when 'error' then 'x' || line when 'view' then line || ',more' when 'signup' then '' else line end as value,
        tag not in ('error', 'view', 'signup') as kept from (select tag, uid || ',' || mid || ',' || tag || ',' || ts as line from tag)""",
        "tag",
    ),
    "rejected_entries": sql(
        """select case when score < 2 then 'uid:' || uid || ' ' || mid || ' ' || score else mid || ':' || score end as value,
        score >= 2 as kept from live""",
        "live",
    ),
    "stream_rejects": sql(
        """select case tag when 'error' then '' when 'signup' then uid || '|' || tag || '|' || mid || '|' || ts
        else uid || '|' || mid || '|2.5|' || ts end as value, tag not in ('error', 'signup') as kept from tag""",
        "tag",
    ),
    "load_table": "select o_orderkey, cast(o_custkey as int) o_custkey, o_totalprice from orders",
    "source_log_lines": sql("select value from log_line", "log_line"),
    "source_rating_events": sql("select uid || '|' || mid || '|' || score || '|' || ts as value from live", "live"),
    "overwrite_table": sql("select mid, round(avg, 6) as avg from avg_score", "avg_score"),
    "build_corpus": sql("select * from corpus", "corpus"),
    "upsert_user_recs": sql(
        """select uid, rank, mid, round(score, 6) score from live_list union all
        select uid, rank, mid, round(score, 6) from user_list where uid not in (select uid from live)""",
        "live_list", "user_list",
    ),
    "append_ratings": sql("select uid, mid, score, ts from rating union all select uid, mid, score, ts from live", "rating", "live"),
    "append_tags": sql("select uid, mid, tag, ts from tag union all select uid, mid, upper(tag), ts from tag", "tag"),
    "format_rating_log": sql(
        "select 'MOVIE_RATING_PREFIX:' || uid || '|' || mid || '|' || score || '|' || ts as value from rating", "rating"
    ),
    "sink_filtered_log": sql(_FILTERED, "log_line"),
    "delete_rating": sql(
        "select uid, mid, score, ts from rating r where not exists (select 1 from live l where l.uid = r.uid and l.mid = r.mid)",
        "rating", "live",
    ),
    "delete_items": sql("select mid, name from movie where mid not in (select mid from tag)", "movie", "tag"),
    "delete_users": "select c_custkey uid, c_name username from customer where c_acctbal >= 0",
    "register_users": f"""select c_custkey uid, c_name username, true as first from customer union all
        select distinct {_hash("s_name")} uid, s_name, true from supplier where s_name not in (select c_name from customer)""",
    "upsert_ratings": sql(
        """select uid, mid, score, ts from rating r where not exists (select 1 from live l where l.uid = r.uid and l.mid = r.mid)
        union all select uid, mid, score, ts from (select uid, mid, score, ts, row_number() over
        (partition by uid, mid order by ts desc, score desc) n from live) where n = 1""",
        "rating", "live",
    ),
    "upsert_users": "select c_custkey uid, c_name username, c_acctbal >= 0 as first from customer",
    "project_content": sql("select mid, name, replace(genres, '|', ' ') genres from movie", "movie"),
    "project_triples": sql("select uid, mid, score from rating", "rating"),
    "filter_rating_log": sql(_FILTERED, "log_line"),
    "parse_rating_event": sql(_PARSED, "log_line"),
    "filter_positive": _rated_pairs("select uid, mid, round(score, 6) score from pred where round(score, 12) > 0"),
    "filter_similar": sql("select mid, sim_mid, round(score, 6) score from pair_sim where score > 0.3", "pair_sim"),
    "find_by_key": sql("select uid, mid, score, ts from rating where uid in (select uid from live)", "rating", "live"),
    "find_items_in": sql("select mid, name, genres from movie where mid in (select mid from tag)", "movie", "tag"),
    "exists_flag": sql(
        """select l.uid, l.mid, exists (select 1 from rating r where r.uid = l.uid and r.mid = l.mid) as found
        from (select distinct uid, mid from live) l""",
        "rating", "live",
    ),
    "items_with_tags": sql("select mid, name, tags from corpus", "corpus"),
    "items_with_avg": sql("select mid, name, round(avg, 6) as avg from movie join avg_score using (mid)", "movie", "avg_score"),
    "genre_match": sql(
        """select m.mid, c.g category from movie m, (select unnest(['anvil', 'blue', 'bolt', 'cold', 'gear', 'gizmo', 'hot', 'large',
        'new', 'old', 'plate', 'red', 'ring', 'rod', 'small', 'widget']) g) c where contains(lower(m.genres), c.g)""",
        "movie",
    ),
    "all_pairs_cosine": sql("select mid, sim_mid, round(score, 6) score from pair_sim where score > 0.3", "pair_sim"),
    "join_observed_predicted": sql(
        """select o.uid, o.mid, o.score actual, round(p.score, 6) predicted, count(*) n from rating o
        join (select r.uid, r.mid, a.avg score from rating r join avg_score a using (mid)) p on o.uid = p.uid and o.mid = p.mid
        group by o.uid, o.mid, o.score, p.score""",
        "rating", "avg_score",
    ),
    "candidate_x_recent": sql("select uid, mid, pos, recent_mid, recent_score from cand_pair", "cand_pair"),
    "sim_lookup": sql("select uid, mid, pos, recent_mid, recent_score, round(sim, 6) sim from cand_pair", "cand_pair"),
    "exclude_rated": sql(
        "select distinct uid, mid from tag t where not exists (select 1 from live l where l.uid = t.uid and l.mid = t.mid)",
        "tag", "live",
    ),
    "my_rated_items": sql(
        """select r.uid, r.mid, r.score, m.name from (select *, row_number() over
        (partition by uid, mid order by ts desc, ok desc, ln desc) n from rating) r join movie m on m.mid = r.mid where n = 1""",
        "rating", "movie",
    ),
    "match_pref_genre": sql(
        """select u.uid, g.genres, g.rank, g.mid, round(g.avg, 6) score from user_pref u
        join genre_list g on g.genres = split_part(u.prefGenres[1], ' ', 1)""",
        "user_pref", "genre_list",
    ),
    "rate_more": sql("select mid, count(*) as count from rating group by mid", "rating"),
    "rate_more_recently": sql("select mid, num, cast(yearmonth as int) yearmonth from monthly", "monthly"),
    "average_score": sql("select mid, round(avg, 6) as avg from avg_score", "avg_score"),
    "tags_per_item": sql("select mid, string_agg(distinct tag, '|' order by tag) tags from tag group by mid", "tag"),
    "rank_lists": _rated_pairs(
        """select uid, rank, mid, round(score, 6) score from (select *, row_number() over
        (partition by uid order by round(score, 12) desc, mid) as rank from pred) where rank <= 20"""
    ),
    "distinct_ids": sql("select distinct uid from rating", "rating"),
    "rmse": sql(
        """select round(sqrt(avg(pow(o.score - p.score, 2))), 6) rmse from rating o
        join (select r.uid, r.mid, a.avg score from rating r join avg_score a using (mid)) p on o.uid = p.uid and o.mid = p.mid""",
        "rating", "avg_score",
    ),
    "score_candidates": sql("select uid, mid, round(score, 6) score from scored", "scored"),
    "rating_histogram": sql(
        """select u.uid, b.bin, count(r.uid) n from (select distinct uid from rating) u
        cross join (select unnest(range(1, 11)) / 2 as bin) b
        left join rating r on r.uid = u.uid and floor(r.score / 0.5 + 0.5) / 2 = b.bin group by u.uid, b.bin""",
        "rating",
    ),
    "append_prefs": sql(
        """select cast(uid as bigint) uid, false as first, unnest([prefGenres[1], c_mktsegment, 'red']) pref, unnest([0, 1, 2]) pos
        from user_pref join customer on c_custkey = uid""",
        "user_pref",
    ),
    "genre_top": sql("select genres, rank, mid, round(avg, 6) as avg from genre_list", "genre_list"),
    "user_top": _rated_pairs(
        """select uid, rank, mid, round(score, 6) score from (select *, row_number() over
        (partition by uid order by round(score, 12) desc, mid) as rank from pred where round(score, 12) > 0) where rank <= 20"""
    ),
    "similar_items": sql(
        """select mid, sim_mid, round(score, 6) score, row_number() over (partition by mid order by score desc, sim_mid) as rank
        from pair_sim where score > 0.3""",
        "pair_sim",
    ),
    "similar_items_top": sql(
        """select mid, sim_mid, round(score, 6) score, rank from (select *, row_number() over
        (partition by mid order by score desc, sim_mid) as rank from sim) where rank <= 5""",
        "sim",
    ),
    "top_candidates": sql("select uid, rank, mid, round(score, 6) score from cand", "cand"),
    "recent_ratings": sql(
        """select uid, pos, mid, score from (select *, row_number() over
        (partition by uid order by ts desc, ok desc, ln desc, mid desc) pos from rating) where pos <= 20""",
        "rating",
    ),
    "hot_items": sql(
        "select mid, num, cast(yearmonth as int) yearmonth, 0.0::double score from monthly order by yearmonth desc, num desc, mid limit 10",
        "monthly",
    ),
    "most_rated_items": sql(
        "select mid, num, cast(yearmonth as int) yearmonth, 0.0::double score from monthly order by num desc, yearmonth desc, mid limit 10",
        "monthly",
    ),
    "most_rated_all_time": sql(
        "select mid, count(*) as count, 0.0::double score from rating group by mid order by count(*) desc, mid limit 10", "rating"
    ),
    "newest_items": sql("select mid, name, issue from movie order by issue desc, mid limit 10", "movie"),
    "newest_items_by_date": sql(
        "select mid, name, issue from movie order by strptime(issue, '%B %d, %Y') desc, mid limit 10", "movie"
    ),
    "head_of_list": sql(
        """select u.uid, l.rank - 1 pos, l.mid, round(l.score, 6) score from user_pref u
        left join (select * from user_list where rank <= 5) l on l.uid = u.uid""",
        "user_pref", "user_list",
    ),
    "best_params": sql(
        """select ln as rank, score as lambda, round(sqrt(avg(pow(score - avg, 2))), 6) rmse from rating join avg_score using (mid)
        group by ln, score order by sqrt(avg(pow(score - avg, 2))), ln, score limit 1""",
        "rating", "avg_score",
    ),
    "hybrid": _hybrid("select uid, rank, mid, round(score, 6) score from hybrid"),
    "hybrid_sum": _hybrid(
        """select uid, rank, mid, round(score, 6) score from (select *, row_number() over
        (partition by uid order by score desc, mid) as rank from (select uid, mid, round(sum(score), 12) score from lined
        group by uid, mid)) where rank <= 8"""
    ),
    "split_ratings": sql(
        """select uid, mid, ok, ln, case when cast('0x' || substr(md5(concat_ws('|', 7, uid, mid, ts, ok, ln)), 1, 8) as bigint)
        / 4294967296.0::double < 0.8::double then 'train' else 'test' end part from rating""",
        "rating",
    ),
    "with_fallback": sql(_FALLBACK.format(recs="live_list", n=10), "live_list", "user_pref", "genre_list"),
    "year_month": sql(
        """select uid, mid, ts, cast(strftime(to_timestamp(ts) at time zone 'UTC', '%Y%m') as int) yearmonth from rating""", "rating"
    ),
    "cosine": _rated_pairs(
        """select uid, mid, round(score / (sqrt(list_dot_product(u.features, u.features))
        * sqrt(list_dot_product(i.features, i.features))), 6) score
        from pred join user_vec u using (uid) join item_vec i using (mid)"""
    ),
    "log10_count": sql(
        """select mid, round(log10(greatest(1, coalesce(n, 1))), 6) weight from movie
        left join (select mid, count(*) n from tag group by mid) using (mid)""",
        "movie", "tag",
    ),
    "explode_genres": sql("select mid, unnest(string_split(genres, '|')) genre from movie", "movie"),
    "contains_ci": "select p_partkey mid, contains(lower(p_type), lower(split_part(p_name, ' ', 1))) found from part",
    "half_star_bin": "select floor(l_quantity / 10 / 0.5 + 0.5) / 2 bin, count(*) n from lineitem group by 1",
    "norm_epoch": sql("select uid, mid, tag, ts from tag", "tag"),
    "import_queue": sql(
        """select uid, pos, mid, score from (select *, row_number() over
        (partition by uid order by ts desc, ok desc, ln desc, mid desc) pos from rating) where pos <= 40""",
        "rating",
    ),
    "user_id_of": f"select c_name username, {_hash('c_name')} uid from customer",
    "first_word": "select p_partkey, split_part(p_name, ' ', 1) word from part",
    "split_prefs": """select p_partkey, unnest(string_split(p_name, ' ')) pref,
        cast(unnest(range(len(string_split(p_name, ' ')))) as int) pos from part""",
    "tokenize": sql(
        """select mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) term,
        cast(unnest(range(len(string_split(genres, '|')))) as int) pos from movie""",
        "movie",
    ),
    "term_counts": sql("select mid, term, tf from term_tf", "term_tf"),
    "tfidf": sql("select mid, term, round(weight, 6) weight from term_w", "term_w"),
    "content_similarity": sql(f"select mid, rank, sim_mid, round(score, 6) score from ({_RANKED_CONTENT})", "content_pair"),
    "profile_similarity": sql(
        """select a.gid, b.gid sim_gid, round(coalesce(c.score, 1.0), 6) score
        from (select min(mid) gid from bag group by words) a join (select min(mid) gid from bag group by words) b on true
        left join content_pair c on c.mid = a.gid and c.sim_mid = b.gid
        where a.gid = b.gid or c.score > 0.6""",
        "bag", "content_pair",
    ),
    "similar_to": sql(
        """select mid, sim_mid, round(score, 6) score from content_pair where score > 0.6 and mid in
        (select mid from monthly order by yearmonth desc, num desc, mid limit 10)""",
        "content_pair", "monthly",
    ),
    "score_factors": _rated_pairs("select uid, mid, round(score, 6) score, copies from pred"),
    "top_products": sql("select uid, rank, mid, round(score, 6) score from user_list", "user_list"),
    "search": _bm25(
        f"select qid, unnest(list_distinct({_words('name')})) term from (select name, min(mid) qid from movie group by name)",
        {"name": "name", "descri": "descri"}, 10, False, "movie",
    ),
    "search_index": _bm25(
        f"select qid, unnest(list_distinct({_words('name')})) term from (select name, min(mid) qid from movie group by name)",
        {"name": "name", "descri": "descri"}, 10, False, "movie",
    ),
    "more_like_this": _bm25(
        f"""select mid qid, term from (select s.mid, s.term, row_number() over (partition by s.mid
            order by round(s.n * ln(((select count(*) from corpus) + 1) / (df.df + 1)), 12) desc, s.term) r
            from (select mid, term, count(*) n from (select mid, unnest({_words("concat_ws(' ', name, descri, genres, tags)")}) term from corpus
            where mid in (select mid from monthly order by yearmonth desc, num desc, mid limit 10)) group by all) s
            join df on df.term = s.term) where r <= 25""",
        {"all": "concat_ws(' ', name, descri, genres, tags)"}, 10, True, "monthly",
    ),
    "fuzzy_genre": sql(
        f"""select qid, rank, mid, round(score, 6) score from (select *, row_number() over
        (partition by qid order by score desc, mid) as rank from (
        select qid, mid, round(max(1 - levenshtein(q, token) / least(length(q), length(token))), 12) score
        from (select lower(prefGenres[1]) q, min(uid) qid from user_pref group by 1) u,
        (select distinct mid, unnest({_words("genres")}) token from corpus) k
        where levenshtein(q, token) <= {_EDIT_LIMIT} group by qid, mid)) where rank <= 10""",
        "corpus", "user_pref",
    ),
    "view_similar": sql(
        """select s.mid for_mid, s.rank, m.mid, round(s.score, 6) score, m.name from (select *, row_number() over
        (partition by mid order by score desc, sim_mid) as rank from sim) s join movie m on m.mid = s.sim_mid
        where s.rank <= 10 and s.mid in (select mid from movie)""",
        "sim", "movie",
    ),
    "view_wish": sql(
        f"""select f.uid, f.rank, f.mid, f.score, m.name from ({_FALLBACK.format(recs="known", n=10)}) f join movie m using (mid)""".replace(
            "known", "(select * from user_list where uid in (select uid from user_pref))"
        ),
        "user_list", "user_pref", "genre_list", "movie",
    ),
    "view_guess": _hybrid(
        f"""select f.uid, f.rank, f.mid, f.score, m.name from ({_FALLBACK.format(recs="known", n=8)}) f join movie m using (mid)""".replace(
            "known", "(select * from hybrid where uid in (select uid from user_pref))"
        ),
        "user_pref", "genre_list", "movie",
    ),
    "view_stream": sql(
        "select uid, rank, mid, round(score, 6) score from live_list where rank <= 10 and uid in (select uid from user_pref)",
        "live_list", "user_pref",
    ),
    "view_genre_top": sql(
        """select genres, rank, mid, round(avg, 6) as avg from genre_list
        where rank <= 5 and genres in (select prefGenres[1] from user_pref)""",
        "genre_list", "user_pref",
    ),
    "view_item": sql(
        "select * from movie where mid in (select mid from monthly order by yearmonth desc, num desc, mid limit 10)", "movie", "monthly"
    ),
    "view_tags": sql("select uid, mid, tag, ts from tag where mid in (select mid from movie)", "tag", "movie"),
    "view_my_tags": sql(
        "select uid, mid, tag, ts from tag t where exists (select 1 from live l where l.uid = t.uid and l.mid = t.mid)", "tag", "live"
    ),
    "register_views": sql(
        """select m.name, count(*) n, round(avg(r.score), 6) as avg from rating r join movie m on m.mid = r.mid group by m.name""",
        "rating", "movie",
    ),
    "sql_rate_more": sql("select mid, count(*) as count from rating group by mid", "rating"),
    "sql_rating_months": sql(
        """select mid, score, cast(year(to_timestamp(ts) at time zone 'UTC') * 100 + month(to_timestamp(ts) at time zone 'UTC') as int)
        as yearmonth from rating""",
        "rating",
    ),
    "sql_rate_more_recently": sql("select mid, num, cast(yearmonth as int) as yearmonth from monthly", "rating", "monthly"),
    "sql_average_score": sql("select mid, round(avg, 6) as avg from avg_score", "avg_score", "rating"),
    "sql_items_of_genre": sql(
        "select m.mid, m.name, round(a.avg, 6) as avg from movie m join avg_score a using (mid) where contains(lower(m.genres), 'red')",
        "movie", "rating", "avg_score",
    ),
    "stream_filter_log": sql(_FILTERED, "log_line"),
    "stream_parse": sql(_PARSED, "log_line"),
    "stream_recent_state": sql(
        """select uid, pos, mid, score, ts from (select *, row_number() over
        (partition by uid order by ts desc, mid desc, score desc) pos from live) where pos <= 40""",
        "live",
    ),
    "stream_seeded_queue": sql(
        """select uid, pos, mid, score from (select *, row_number() over
        (partition by uid order by ts desc, mid desc, score desc) pos from live) where pos <= 40""",
        "live",
    ),
    "stream_statistics": sql(
        """select mid, cast(year(to_timestamp(ts) at time zone 'UTC') * 100 + month(to_timestamp(ts) at time zone 'UTC') as int) as yearmonth,
        count(*) as num, round(avg(score), 6) as avg from (select mid, ts, score from rating union all select mid, ts, score from live)
        group by 1, 2""",
        "rating", "live",
    ),
    "stream_log_tail": sql(
        """select uid || '|' || mid || '|' || score || '|' || ts as value from live
        where ts >= (select (min(ts) + max(ts)) / 2 from ev)""",
        "live", "ev",
    ),
    "stream_recommend": sql("select uid, rank, mid, round(score, 6) score from live_list", "live_list"),
    "batch_recommend": sql("select uid, mid, round(score, 6) score from scored", "scored"),
}

ORACLES["search_blocks"] = ORACLES["search"]
ORACLES["profile_similarity_indexed"] = ORACLES["profile_similarity"]

# Positions are ints in the results; DuckDB numbers rows with bigints.
_POSITIONS = {
    "rank": (
        "upsert_user_recs", "match_pref_genre", "rank_lists", "genre_top", "user_top", "similar_items", "similar_items_top",
        "top_candidates", "hybrid", "hybrid_sum", "with_fallback", "content_similarity", "top_products", "search", "search_blocks", "search_index",
        "more_like_this", "fuzzy_genre", "view_similar", "view_wish", "view_guess", "view_stream", "view_genre_top", "stream_recommend",
    ),
    "pos": ("candidate_x_recent", "sim_lookup", "recent_ratings", "head_of_list", "import_queue", "stream_recent_state", "stream_seeded_queue"),
}
for _column, _names in _POSITIONS.items():
    for _name in _names:
        ORACLES[_name] = f"select * replace (cast({_column} as int) as {_column}) from (\n{ORACLES[_name]})"
