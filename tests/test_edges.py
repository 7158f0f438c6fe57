"""Hand-made rows at the edges of each operator."""

from __future__ import annotations

import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ratingloom.functions import scalars
from ratingloom.functions.queues import import_queue
from ratingloom.operators import factors, lists, realtime, search, stats, vectors
from ratingloom.plans import content, serving
from ratingloom.sources import files, rejects, sinks, versions
from ratingloom.streaming import logs


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def text_file(tmp_path, *lines, end="\n"):
    path = tmp_path / "lines.txt"
    path.write_text(end.join(lines) + end, newline="")
    return str(path)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_item_line_with_blank_last_field_is_kept(spark, tmp_path):
    path = text_file(tmp_path, "1^ A ^d^90^June 1, 2001^^en^War^x^", "x^B^^^^^^^^", "2^short")
    kept = files.scan_items(spark, path)
    assert rows(kept, "mid", "name", "directors") == [(1, "A", "")]
    every = files.scan_items(spark, path, on_error="keep")
    assert rows(rejects.rejected(every), "value") == [("2^short",), ("x^B^^^^^^^^",)]


def test_rejected_lines_are_stored_and_counted(spark, tmp_path):
    path, out = text_file(tmp_path, "1,2,a,3", "", "x,2,a,3", "1,2,a,b,3"), str(tmp_path / "rejects")
    assert files.scan_tags(spark, path, rejects=out).count() == 1
    assert rows(files.rejected_lines(spark, out), "value") == [("",), ("1,2,a,b,3",), ("x,2,a,3",)]
    split = rejects.store_split(files.scan_tags(spark, path, on_error="keep"), str(tmp_path / "again"))
    assert (split.n_rows, split.n_rejected, split.rows.count(), split.rejected.count()) == (1, 3, 1, 3)
    empty = files.scan_tags(spark, text_file(tmp_path, end=""), rejects=str(tmp_path / "none"))
    assert empty.count() == 0 and files.rejected_lines(spark, str(tmp_path / "none")).count() == 0


def test_item_line_ignores_surplus_fields(spark, tmp_path):
    assert files.scan_items(spark, text_file(tmp_path, "1^" + "^".join("abcdefghi") + "^more")).count() == 1


def test_malformed_line_can_fail_the_job(spark, tmp_path):
    path = text_file(tmp_path, "1,31,2.5,1260759144", "1,x,2.5,1260759144")
    assert files.scan_ratings(spark, path).count() == 1
    with pytest.raises(PySparkException):
        files.scan_ratings(spark, path, on_error="fail").collect()


def test_score_scale(spark, tmp_path):
    path = text_file(tmp_path, "1,31,7,1260759144")
    assert files.scan_ratings(spark, path, score_scale=0.5).first()["score"] == 3.5


def test_tag_lines(spark, tmp_path):
    path = text_file(tmp_path, "15,339,sandra 'boring' bullock,1138537770", "15,1,a,b,1138537770", "z,1,a,1", end="\r\n")
    assert rows(files.scan_tags(spark, path), "uid", "mid", "tag", "ts") == [(15, 339, "sandra 'boring' bullock", 1138537770)]


def test_log_filter(spark):
    lines = spark.createDataFrame(
        [
            ("INFO a - MOVIE_RATING_PREFIX:1|2|3.5|100 ",),
            ("MOVIE_RATING_PREFIX:",),
            ("MOVIE_RATING_PREFIX:1|2|4.0|101 MOVIE_RATING_PREFIX:9|9|9|9",),
            ("nothing here",),
            ("MOVIE_RATING_PREFIX:\t\t",),
        ],
        "value string",
    )
    assert rows(logs.filter_rating_log(lines), "value") == [("",), ("",), ("1|2|3.5|100",), ("1|2|4.0|101",)]


def test_malformed_events_are_set_apart(spark):
    events = spark.createDataFrame([("1|2|3.5|100",), ("1|2|x|100",), ("1|2|3",), ("",)], "value string")
    parsed = logs.parse_rating_event(events)
    assert rows(rejects.good(parsed), "uid", "mid", "score", "ts") == [(1, 2, 3.5, 100)]
    assert rows(rejects.rejected(parsed), "value") == [("",), ("1|2|3",), ("1|2|x|100",)]


def test_milliseconds_give_the_same_month(spark):
    assert value(spark, scalars.year_month(F.lit(1260759144))) == 200912
    assert value(spark, scalars.year_month(F.lit(1260759144000))) == 200912
    assert value(spark, scalars.year_month(F.lit(1259625600 - 1))) == 200911
    assert value(spark, scalars.year_month(F.lit(1259625600 - 1), offset_seconds=28800)) == 200912


@pytest.mark.parametrize(
    "name,uid",
    [("polygenelubricants", -2147483648), ("", 0), ("a", 97), ("hello", 99162322), ("é", 233), ("\U0001F600", 1772899)],
)
def test_user_id(spark, name, uid):
    assert value(spark, scalars.user_id_of(F.lit(name))) == uid


def test_histogram_counts_five_stars(spark):
    rating = spark.createDataFrame([(1, 1, 5.0, 0), (1, 2, 0.5, 0), (1, 3, 5.0, 0)], "uid int, mid int, score double, ts long")
    bins = dict(rows(stats.rating_histogram(rating), "bin", "n"))
    assert len(bins) == 10 and bins[5.0] == 2 and bins[0.5] == 1 and sum(bins.values()) == 3


def test_genre_match_is_a_substring_match(spark):
    movie = spark.createDataFrame([(1, "Warfare|drama"), (2, ""), (3, None)], "mid int, genres string")
    assert rows(stats.genre_match(movie), "mid", "category") == [(1, "Drama"), (1, "War")]


def test_cuts_are_strict_and_nan_never_passes(spark):
    pairs = spark.createDataFrame(
        [(1, 2, 0.6), (1, 3, 0.6000001), (1, 4, float("nan")), (1, 5, 0.1 + 0.5)], "mid int, sim_mid int, score double"
    )
    assert rows(lists.filter_similar(pairs), "sim_mid") == [(3,)]


def test_zero_vectors_are_similar_to_nothing(spark):
    vecs = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 0.0])], "mid int, features array<double>")
    assert rows(vectors.all_pairs_cosine(vecs), "mid", "sim_mid", "score") == [(2, 3, 1.0), (3, 2, 1.0)]
    assert value(spark, scalars.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) is None


def test_similarity_exactly_at_the_cut_is_excluded(spark):
    vecs = spark.createDataFrame([(1, [3.0, 4.0]), (2, [1.0, 0.0])], "mid int, features array<double>")
    assert vectors.all_pairs_cosine(vecs, 0.6).count() == 0
    assert vectors.all_pairs_cosine(vecs, 0.59).count() == 2


SCORING = "uid int, mid int, recent_mid int, recent_score double, sim double"


@pytest.mark.parametrize(
    "ratings,expected",
    [
        ([4.0], 4.0),
        ([3.0], 3.0),
        ([2.0] * 10, 2.0 - 1.0),
        ([5.0] * 10, 5.0 + 1.0),
        ([4.0, 4.0, 3.0, 3.0, 3.0], 3.4 + math.log10(2) - math.log10(3)),
    ],
)
def test_liked_and_disliked_counts(spark, ratings, expected):
    pairs = spark.createDataFrame([(1, 9, i, score, 1.0) for i, score in enumerate(ratings)], SCORING)
    assert realtime.score_candidates(pairs).first()["score"] == pytest.approx(expected)


def test_similarity_at_the_gate_does_not_count(spark):
    pairs = spark.createDataFrame([(1, 9, 1, 5.0, 0.7), (1, 8, 1, 5.0, 0.71)], SCORING)
    assert rows(realtime.score_candidates(pairs), "mid") == [(8,)]


def test_unknown_item_and_exhausted_user_get_an_empty_list(spark):
    events = spark.createDataFrame([(1, 99, 4.0, 5), (2, 10, 4.0, 5)], "uid int, mid int, score double, ts long")
    rating = events.unionByName(spark.createDataFrame([(2, 11, 2.0, 1)], events.schema))
    sim = spark.createDataFrame([(10, 1, 11, 0.9), (11, 1, 10, 0.9)], "mid int, rank int, sim_mid int, score double")
    scored = realtime.batch_recommend(events, rating, sim)
    assert rows(realtime.recommendation_lists(events, scored), "uid", "recs") == [(1, []), (2, [])]


def test_empty_list_replaces_the_old_one_and_replay_changes_nothing(spark, tmp_path):
    schema = "uid int, recs array<struct<mid:int,score:double>>"
    target = str(tmp_path / "recs")
    sinks.upsert_user_recs(spark.createDataFrame([(1, [(5, 1.0)]), (2, [(6, 1.0)])], schema), target, 0)
    for _ in range(2):
        sinks.upsert_user_recs(spark.createDataFrame([(1, [])], schema), target, 1)
    assert rows(sinks.current_user_recs(spark, target), "uid", "recs") == [(1, []), (2, [(6, 1.0)])]


def test_import_queue(spark):
    dump = spark.createDataFrame([("uid:7", [" 31 : 2.5 ", "32:4.0", "broken"]), ("other", ["1:1"])], "key string, entries array<string>")
    found = import_queue(dump)
    assert rows(rejects.good(found), "uid", "pos", "mid", "score") == [(7, 1, 31, 2.5), (7, 2, 32, 4.0)]
    assert rows(rejects.rejected(found), "value") == [("other 1:1",), ("uid:7 broken",)]


def test_blank_text_still_gives_one_token(spark):
    movie = spark.createDataFrame([(1, "n", ""), (2, "n", "War|Drama")], "mid int, name string, genres string")
    tokens = content.tokenize(content.project_content(movie))
    assert rows(tokens, "mid", "words") == [(1, [""]), (2, ["war", "drama"])]


def test_hashed_weights_equal_exact_ones_without_collisions(spark):
    movie = spark.createDataFrame([(1, "n", "War|War|Drama"), (2, "n", "Drama")], "mid int, name string, genres string")
    tokens = content.tokenize(content.project_content(movie))
    exact = {(r["mid"], round(r["weight"], 9)) for r in content.tfidf(content.term_counts(tokens), movie).collect()}
    hashed = content.tfidf(content.term_counts(tokens, 50)).select("mid", content.vector_to_array("features").alias("f"))
    found = {(r["mid"], round(w, 9)) for r in hashed.collect() for w in r["f"] if w}
    assert {e for e in exact if e[1]} == found


def test_rmse_counts_repeats_on_both_sides(spark):
    obs = spark.createDataFrame([(1, 1, 4.0), (1, 1, 2.0), (1, 2, 3.0)], "uid int, mid int, score double")
    pred = spark.createDataFrame([(1, 1, 3.0), (1, 1, 3.0), (9, 9, 1.0)], "uid int, mid int, score double")
    assert factors.rmse(obs, pred).first()["rmse"] == pytest.approx(1.0)
    assert factors.rmse(obs, pred.where("uid = 9")).first()["rmse"] is None


def test_best_params_passes_over_nan(spark):
    grid = spark.createDataFrame([(1, 0.1, float("nan")), (2, 0.1, 1.5), (3, 0.1, 1.2), (4, 0.1, None)], "rank int, lambda double, rmse double")
    assert factors.best_params(grid).first()["rank"] == 3


def test_registration_skips_taken_names(spark):
    user = spark.createDataFrame([(1, "ann", False, 0, ["War"])], "uid long, username string, first boolean, ts long, prefGenres array<string>")
    new = spark.createDataFrame([("ann",), ("bob",), ("bob",)], "username string")
    both = sinks.register_users(user, new, F.lit(5))
    assert rows(both, "username", "uid", "first", "ts") == [("ann", 1, False, 0), ("bob", 97717, True, 5)]


def test_prefs_are_appended_with_repeats(spark):
    user = spark.createDataFrame([("ann", True, ["War"]), ("bob", True, ["Drama"])], "username string, first boolean, prefGenres array<string>")
    updates = spark.createDataFrame([("ann", "Drama,War,")], "username string, genres string")
    after = stats.append_prefs(user, updates)
    assert rows(after, "username", "first", "prefGenres") == [("ann", False, ["War", "Drama", "War"]), ("bob", True, ["Drama"])]


def test_hybrid_keeps_repeats_and_order(spark):
    schema = "uid int, rank int, mid int, score double"
    cf = spark.createDataFrame([(1, 1, 10, 0.9)], schema)
    cb = spark.createDataFrame([(1, 1, 10, 4.0), (1, 2, 11, 3.0)], schema)
    sr = spark.createDataFrame([(2, 1, 12, 1.0)], schema)
    appended = serving.hybrid(cf, cb, sr, 2)
    assert [(u, r, m, round(s, 6)) for u, r, m, s in rows(appended, "uid", "rank", "mid", "score")] == [
        (1, 1, 10, 0.27), (1, 2, 10, 1.2), (2, 1, 12, 0.4),
    ]
    summed = serving.hybrid(cf, cb, sr, 2, fuse="sum")
    assert [(u, r, m, round(s, 6)) for u, r, m, s in rows(summed, "uid", "rank", "mid", "score")] == [
        (1, 1, 10, 1.47), (1, 2, 11, 0.9), (2, 1, 12, 0.4),
    ]


def test_fallback_picks_one_preference_by_its_first_word(spark):
    recs = spark.createDataFrame([(1, 1, 5, 1.0)], "uid int, rank int, mid int, score double")
    user = spark.createDataFrame([(1, ["War"]), (2, ["Science fiction"]), (3, [])], "uid int, prefGenres array<string>")
    top = spark.createDataFrame([("Science", 1, 7, 4.5), ("Science", 2, 8, 4.0)], "genres string, rank int, mid int, avg double")
    assert rows(serving.with_fallback(recs, user, top, 1), "uid", "mid") == [(1, 5), (2, 7)]


def test_head_of_list_without_a_list(spark):
    recs = spark.createDataFrame([(1, [(5, 1.0), (6, 0.5)])], "uid int, recs array<struct<mid:int,score:double>>")
    keys = spark.createDataFrame([(1,), (2,)], "uid int")
    assert rows(lists.head_of_list(recs, 1, keys), "uid", "recs") == [(1, [(5, 1.0)]), (2, [])]


def test_newest_by_text_and_by_date(spark):
    movie = spark.createDataFrame([(1, "September 21, 2004"), (2, "April 1, 2010"), (3, "no date")], "mid int, issue string")
    assert [r["mid"] for r in stats.newest_items(movie, 2).collect()] == [3, 1]
    assert [r["mid"] for r in stats.newest_items(movie, 3, by="date").collect()] == [2, 1, 3]


def test_fuzzy_limits_follow_the_length(spark):
    corpus = spark.createDataFrame(
        [(1, "War"), (2, "Wart"), (3, "Tv"), (4, "Western"), (5, "Wstrn"), (6, "Animation")], "mid int, genres string"
    )
    asked = spark.createDataFrame([(1, "war"), (2, "tv"), (3, "tw"), (4, "western"), (5, "amination")], "qid int, text string")
    found = {(r["qid"], r["mid"]) for r in search.fuzzy_genre(corpus, asked).collect()}
    assert found == {(1, 1), (1, 2), (2, 3), (4, 4), (4, 5), (5, 6)}


def test_fuzzy_equals_brute_force(spark):
    words = ["a", "ab", "abc", "abd", "abcd", "abcde", "abxde", "bacde", "abcdef", "badcfe", "abcdefg", "xyabcdefg", ""]
    corpus = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "mid int, genres string")
    asked = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "qid int, text string")

    def distance(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, line = line, [i]
            for j, y in enumerate(b, 1):
                line.append(min(last[j] + 1, line[-1] + 1, last[j - 1] + (x != y)))
        return line[-1]

    limit = lambda w: 0 if len(w) <= 2 else 1 if len(w) <= 5 else 2
    expected = {(i, j) for i, q in enumerate(words) for j, w in enumerate(words) if q and w and distance(q, w) <= limit(q)}
    assert {(r["qid"], r["mid"]) for r in search.fuzzy_genre(corpus, asked, n=100).collect()} == expected


def test_fuzzy_meets_long_words(spark):
    base = "abcdefghijklmnopqrstuvwxyz"
    words = [base[:n] for n in (18, 19, 20, 21, 22, 23, 24)] + [base, base[1:], base[2:], base[3:], "x" + base, base[:12] + "X" + base[12:], base[:5] + base[7:], base * 3, "y" * 1000]
    corpus = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "mid int, genres string")
    asked = spark.createDataFrame([(i, w) for i, w in enumerate(words[:-1])], "qid int, text string")

    def near(a, b):
        line = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, line = line, [i]
            for j, y in enumerate(b, 1):
                line.append(min(last[j] + 1, line[-1] + 1, last[j - 1] + (x != y)))
        return line[-1] <= 2

    expected = {(i, j) for i, q in enumerate(words[:-1]) for j, w in enumerate(words) if abs(len(q) - len(w)) < 3 and near(q.lower(), w.lower())}
    assert {(r["qid"], r["mid"]) for r in search.fuzzy_genre(corpus, asked, n=100).collect()} == expected


def test_ragged_vectors_are_refused(spark):
    vecs = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0])], "mid int, features array<double>")
    with pytest.raises(PySparkException):
        vectors.all_pairs_cosine(vecs).collect()


def test_upsert_keeps_the_newest_update_of_a_key(spark):
    rating = spark.createDataFrame([(1, 1, 1.0, 5), (1, 2, 2.0, 5)], "uid int, mid int, score double, ts long")
    updates = spark.createDataFrame([(1, 1, 3.0, 6), (1, 1, 4.0, 7), (2, 2, 5.0, 1)], rating.schema)
    assert rows(sinks.upsert_ratings(rating, updates), "uid", "mid", "score") == [(1, 1, 4.0), (1, 2, 2.0), (2, 2, 5.0)]


def test_prefs_of_a_user_without_a_list_and_of_two_updates(spark):
    user = spark.createDataFrame([("ann", True, None), ("bob", True, ["War"])], "username string, first boolean, prefGenres array<string>")
    updates = spark.createDataFrame([("ann", "Drama"), ("bob", "Music"), ("bob", "Comedy,Tv"), ("bob", None)], "username string, genres string")
    assert rows(stats.append_prefs(user, updates), "username", "first", "prefGenres") == [
        ("ann", False, ["Drama"]), ("bob", False, ["War", "Comedy", "Tv", "Music"]),
    ]


def test_rewritten_table_reads_what_it_replaces(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in range(3):
        old = sinks.current_table(spark, path) if n else spark.createDataFrame([], "id long")
        sinks.rewrite_table(old.unionByName(spark.range(n, n + 1)), path)
    assert rows(sinks.current_table(spark, path), "id") == [(0,), (1,), (2,)]
    versions.drop_older(spark, path)
    assert rows(sinks.current_table(spark, path), "id") == [(0,), (1,), (2,)]
    with pytest.raises(FileNotFoundError):
        sinks.current_table(spark, str(tmp_path / "nothing"))


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    sinks.rewrite_table(spark.range(1), path)
    seen = versions.current_version(spark, path)
    sinks.rewrite_table(spark.range(2), path)
    monkeypatch.setattr(versions, "current_version", lambda *a: seen)
    with pytest.raises(RuntimeError):
        sinks.rewrite_table(spark.range(3), path)
    monkeypatch.undo()
    assert sinks.current_table(spark, path).count() == 2


def test_compacted_lists_go_on(spark, tmp_path):
    schema, target = "uid int, recs array<struct<mid:int,score:double>>", str(tmp_path / "recs")
    for batch in range(3):
        sinks.upsert_user_recs(spark.createDataFrame([(batch % 2, [(batch, 1.0)])], schema), target, batch)
        if batch == 1:
            sinks.compact_state(spark, target)
    assert rows(sinks.current_user_recs(spark, target), "uid", "recs") == [(0, [(2, 1.0)]), (1, [(1, 1.0)])]
    sinks.compact_state(spark, target)
    versions.drop_older(spark, target)
    assert rows(sinks.current_user_recs(spark, target), "uid", "recs") == [(0, [(2, 1.0)]), (1, [(1, 1.0)])]


def test_ranks_of_many_equal_scores(spark, monkeypatch):
    monkeypatch.setattr(lists, "BAND_ROWS", 50)
    data = [(1, i * 7 % 1000, 1.0 if i % 3 else i / 1000) for i in range(1000)] + [(2, 5, 0.7)]
    pairs = spark.createDataFrame(data, "mid int, sim_mid int, score double")
    found = lists.banded_rank(pairs, "mid", "sim_mid", "score", 0.0, 1.0).where("mid = 1").orderBy("rank").collect()
    expected = sorted((r for r in data if r[0] == 1), key=lambda r: (-r[2], r[1]))
    assert [(r["rank"], r["sim_mid"]) for r in found] == [(i + 1, r[1]) for i, r in enumerate(expected)]


def test_sparse_blocks_stay_sparse(spark):
    import numpy as np
    import pyarrow as pa

    entries = [[{"term": f"{i}.{j}", "weight": 1.0} for j in range(40)] for i in range(2000)]
    table = pa.table({"features": pa.array(entries, pa.list_(pa.struct([("term", pa.string()), ("weight", pa.float64())])))})
    block = vectors._Sparse(table, True)
    for start, products in block.products(block):
        assert products.nbytes <= 8 * vectors.STRIPE_CELLS
        assert np.allclose(products, np.eye(2000)[start : start + len(products)])


def test_factors_are_freed_after_tuning(spark):
    rating = spark.createDataFrame([(u, m, float((u + m) % 5 + 1)) for u in range(12) for m in range(12)], "uid int, mid int, score double")
    train, test = factors.split_ratings(rating, ("uid", "mid"))
    assert factors.tune_als(train, test, (2, 3), (0.1,), 2).count() == 2
    assert not [r for r in spark.sparkContext._jsc.getPersistentRDDs().values() if r.name() in ("userFactors", "itemFactors")]
