"""Corner cases of single operators."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from parcelspark.operators import aggregates as ag
from parcelspark.operators import features as ft
from parcelspark.operators import joins as jn
from parcelspark.operators import kpi
from parcelspark.operators import models as md
from parcelspark.operators import setops as so
from parcelspark.operators import text as ot
from parcelspark.operators import windows as wn
from parcelspark.plans import listings as ls
from parcelspark.session import scratch_path
from parcelspark.sources import runs as rn
from parcelspark.sources import tables as tb


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_not_in_ignores_null_among_known(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    known = spark.createDataFrame([(2,), (None,), (2,)], "id int")
    assert rows(jn.join_not_in(df, known, "id")) == [(1,)]


def test_full_chain_merges_the_key(spark):
    parts = [spark.createDataFrame([(i, i)], f"id int, v{i} int") for i in (1, 2, 3)]
    assert sorted(rows(jn.join_full_chain(parts, ["id"]))) == [(1, 1, None, None), (2, None, 2, None), (3, None, None, 3)]


def test_star_join_never_broadcasts(spark):
    base = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, i int")
    tables = [spark.createDataFrame([("a", j), ("b", 10 + j), ("b", 20 + j), (None, j)], f"k string, v{j} int") for j in range(3)]
    joined = jn.join_star_left(base, tables, ["k"])
    assert sorted(rows(joined), key=str) == sorted(
        [("a", i, 0, 1, 2) for i in (1, 2)] + [("b", 4, x, y, z) for x in (10, 20) for y in (11, 21) for z in (12, 22)]
        + [(None, 3, None, None, None)], key=str)
    assert "BroadcastExchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_nearest_row_of_each_key_sorts_only_the_nearest(spark):
    nan = float("nan")
    df = spark.createDataFrame(
        [(1, 2.0, 5, "a"), (1, 1.0, 7, "b"), (1, 1.0, 6, "c"), (1, 1.0, 6, "c"), (2, None, 9, "d"), (2, 0.5, 1, "e"), (3, nan, 2, "f"),
         (3, nan, 1, "g"), (None, 4.0, 1, "h"), (None, 3.0, 2, "i"), (5, 0.0, 2, "j"), (5, -0.0, 1, "k"), (6, nan, 1, "l"), (6, 9.0, 2, "m")],
        "k int, d double, t int, v string").repartition("k")
    found = wn.top1_by_distance(df, "k", "d", ["t"])
    assert found.columns == df.columns
    assert {(r.k, r.t, r.v) for r in found.collect()} == {
        (1, 6, "c"), (2, 9, "d"), (3, 1, "g"), (None, 2, "i"), (5, 1, "k"), (6, 2, "m")}
    assert found.count() == 6
    pairs = spark.range(1000).repartition("id").crossJoin(F.broadcast(spark.range(50).select(F.col("id").alias("c")))).select(
        "id", "c", F.abs(F.col("id") % 50 - F.col("c")).alias("d"))
    wide = wn.top1_by_distance(pairs, "id", "d", ["c"])
    assert wide.filter("c = id % 50 and d = 0").count() == 1000
    # the candidates go straight into a hash join, not through an exchange or a sort
    assert "ShuffledHashJoin" in wide._jdf.queryExecution().executedPlan().toString()


def test_arrays_null_and_empty(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "id int, xs array<string>")
    assert rows(ft.array_to_text(df, "xs")) == [(1, "a, b"), (2, None), (3, None)]
    assert rows(ft.explode_inner(df, "xs", "x").select("id", "x")) == [(1, "a"), (1, "b")]
    assert rows(ft.array_count(df, "xs", "n").select("id", "n")) == [(1, 2), (2, 0), (3, None)]
    assert rows(ag.max_per_group(df, "id", "xs", "n")) == [(1, 2)]


def test_weak_negation_needs_all_negatives(spark):
    df = spark.createDataFrame([("attached",), ("attached: no",), ("attached: no attached no",), (None,), ("x",)], "t string")
    out = ft.keyword_flag_weak_negation(df, "t", "f", "attached", ["attached: no", "attached no"])
    assert [r.f for r in out.collect()] == [1, 1, 0, 0, 0]


def test_default_true_and_other_flags(spark):
    df = spark.createDataFrame([("sewer not here",), (None,), ("ok",)], "t string")
    assert [r.f for r in ft.default_true_flag(df, "t", "f", ["sewer not"]).collect()] == [0, 1, 1]
    flags = spark.createDataFrame([(0, 0), (0, 1)], "a int, b int")
    assert [r.o for r in ft.other_flag(flags, ["a", "b"], "o").collect()] == [1, 0]


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (-2.5,), (None,)], "x double")
    assert [r.x for r in ft.cast_rounded_long(df, "x").collect()] == [3, 4, -3, None]


def test_years_and_iso_weeks(spark):
    df = spark.createDataFrame([("1999",), ("n/a",), (None,)], "y string")
    assert [r.out for r in ft.safe_year(df, "y", "out").collect()] == [1999, None, None]
    day = spark.createDataFrame([(date(2021, 1, 1),)], "d date")
    assert rows(ft.iso_week_parts(day, "d")) == [(date(2021, 1, 1), 2020, 53)]


def test_percentages_guard_a_zero_denominator(spark):
    df = spark.createDataFrame([("a", 1, 0), ("b", 1, 3), ("b", 1, 0), ("c", 1, None)], "k string, n int, d int")
    out = {r.k: r.p for r in ag.guarded_percentages(df, ["k"], {"p": ("n", "d")}).collect()}
    assert out == {"a": 0.0, "b": 66.67, "c": None}


def test_area_units(spark):
    df = spark.createDataFrame([(10.0, "SQM", 1000.0, "sqm"), (10.4, None, 5000.0, "SqFt"), (10.5, "ft", 2.0, "acres")],
                               "a double, u string, l double, lu string")
    out = rows(ft.convert_area_units(df, "a", "u", "l", "lu").select("a", "l"))
    assert [r[0] for r in out] == [108, 10, 11]
    assert [r[1] for r in out] == pytest.approx([0.247105, 0.114784, 2.0])


def test_backfill_is_gated_by_the_first_column(spark):
    df = spark.createDataFrame([(1, "A", None, None), (2, "A", 5.0, None), (3, "Z", None, 7.0)],
                               "id int, k string, t double, y double")
    trend = spark.createDataFrame([("A", datetime(2020, 1, 1), 1.0, 10.0), ("A", datetime(2020, 2, 1), 2.0, 20.0),
                                   ("A", datetime(2030, 1, 1), 3.0, 30.0)], "k string, d timestamp, t double, y double")
    out = jn.backfill_latest(df, trend, "k", ["t", "y"], "d", datetime(2021, 1, 1)).select("id", "t", "y")
    assert sorted(rows(out)) == [(1, 2.0, 20.0), (2, 5.0, 0.0), (3, 0.0, 7.0)]


def test_append_is_idempotent_and_by_name(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(path)
    new = spark.createDataFrame([("b", 2, 9), ("x", 1, 9)], "v string, id int, extra int")
    for _ in range(2):
        so.append_new_only(new, path, "id")
    assert sorted(rows(spark.read.parquet(path))) == [(1, "a"), (2, "b")]


def test_append_raises_on_other_columns(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(path)
    more, less = spark.createDataFrame([(2, "b", 3)], "id long, v string, w int"), spark.createDataFrame([(2,)], "id long")
    for df, allowed in ((more, {"drop": ["w"]}), (less, {"fill": ["v"]})):
        with pytest.raises(ValueError):
            tb.append_aligned(df, path)
        tb.append_aligned(df, path, **allowed)
    assert sorted(map(str, rows(spark.read.parquet(path)))) == ["(1, 'a')", "(2, 'b')", "(2, None)"]


def test_append_new_only_raises_when_told_what_may_go(spark):
    path = scratch_path(spark, "t")
    spark.createDataFrame([(1, "a")], "id long, v string").write.parquet(path)
    with pytest.raises(ValueError):
        so.append_new_only(spark.createDataFrame([(2, "b", 9)], "id long, v string, w int"), path, "id", drop=[])


def test_a_part_is_visible_only_when_complete(spark):
    root = scratch_path(spark, "runs")
    schema = "id long"
    assert rn.parts_of(spark, root) == [] and rn.read_parts(spark, root, "base", schema).count() == 0
    broken = spark.range(3).filter("raise_error('lost') IS NULL")
    with pytest.raises(Exception, match="lost"):
        rn.write_part({"base": spark.range(9), "final": broken}, root, "2025-01")
    assert rn.parts_of(spark, root) == []
    rn.write_part({"base": spark.range(9), "final": spark.range(2)}, root, "2025-01")
    rn.write_part({"base": spark.range(1), "final": spark.range(1)}, root, "2025-02")
    with pytest.raises(Exception, match="lost"):  # the run before stays
        rn.write_part({"base": spark.range(5), "final": broken}, root, "2025-01")
    assert rn.read_part(spark, root, "base", "2025-01").count() == 9
    rn.write_part({"base": spark.range(4), "final": spark.range(0)}, root, "2025-01")
    both = rn.read_parts(spark, root, "base", schema)
    assert sorted(rows(both)) == [(0, "2025-01"), (0, "2025-02"), (1, "2025-01"), (2, "2025-01"), (3, "2025-01")]
    assert sorted(rows(rn.read_parts(spark, root, "final", schema, column="of"))) == [(0, "2025-02")]
    assert rows(rn.read_parts(spark, root, "base", schema, before="2025-01")) == []
    with pytest.raises(ValueError):
        rn.read_part(spark, root, "base", "2025-09")


def test_month_run_and_rerun_give_the_same_tables(spark):
    from suite import inputs
    from suite.registry import Tables
    from suite.tables import AS_OF, KNOWN

    t = Tables(spark, "/root/testdata/sf0.001")
    listings, dims, known = tb.written(inputs.nested_listings(t)), inputs.dimensions(t), t.sql(KNOWN)
    root = scratch_path(spark, "months")
    part = ls.month_run(listings, known, dims, "houses", AS_OF, root)
    final, reduced, notsold = (rn.read_part(spark, root, n, part) for n in ("final", "reduced", "notsold"))
    # the smallest data has no home that passes all rules, so this looks at the tables' shape only
    assert reduced.columns == final.columns and reduced.count() <= final.count() and "listing_id" in notsold.columns
    assert rn.parts_of(spark, root) == [part]
    base = rn.read_part(spark, root, "base", part)
    first = sorted(r.listing_id for r in base.select("listing_id").collect())
    assert first and "day_on_market" in base.columns
    ls.month_run(listings, known, dims, "houses", AS_OF, root, with_notsold=False)  # a rerun sees the same listings as new
    assert sorted(r.listing_id for r in rn.read_part(spark, root, "base", part).select("listing_id").collect()) == first
    later = ls.month_run(listings, known, dims, "houses", AS_OF.replace(month=AS_OF.month + 1), root, with_notsold=False)
    assert not set(first) & {r.listing_id for r in rn.read_part(spark, root, "base", later).select("listing_id").collect()}


def test_features_that_repeat_or_are_left_out(spark):
    df = spark.createDataFrame([(i, i % 2, i % 2, float(i % 2), None if i % 3 else 1, "x" if i % 2 else "y", "x") for i in range(20)],
                               "id int, a int, b int, c double, d int, e string, `close_dt (Year)` string")
    assert md.select_features(df).columns == ["id", "a", "b", "c", "d", "e"]
    assert md.select_features(df, md.NO_FEATURES, "id").columns == ["id", "a", "c", "d", "e"]
    assert md.select_features(df.filter("false"), key="id").columns == []
    assert not set(md.NO_FEATURES) & set(md.LEFT_OUT_OF_STATICAL_LIST)


def test_replace_and_versions(spark):
    path = scratch_path(spark, "t")
    tb.replace_table(spark.range(5), path)
    assert tb.replace_table(spark.range(2), path).count() == 2
    root = scratch_path(spark, "v")
    tb.snapshot_version(spark.range(3), root, "d", 1)
    tb.snapshot_version(spark.range(4), root, "d", 2)
    assert tb.read_version(spark, root, "d").count() == 4
    assert tb.read_version(spark, root, "d", 1).count() == 3


def test_like_underscore_is_one_character(spark):
    for name, n in (("zq_a_month", 2), ("zqxa_month", 1), ("zq_empty_month", 0)):
        spark.range(n).createOrReplaceTempView(name)
    assert [r.table_name for r in tb.tables_like(spark, "zq_a%month").collect()] == ["zq_a_month", "zqxa_month"]
    with pytest.raises(ValueError):
        so.union_matching_tables(spark, "no_such%")


def test_split_and_sample_are_complete_and_repeatable(spark):
    df = spark.range(20000)
    split = md.split_tvh(df, "id")
    shares = {r.part: r["count"] for r in split.groupBy("part").count().collect()}
    assert sum(shares.values()) == 20000 and set(shares) == {"train", "validation", "holdout"}
    assert 250 < shares["validation"] < 550 and 250 < shares["holdout"] < 550
    again = md.split_tvh(df.repartition(3), "id").join(split.withColumnRenamed("part", "p2"), "id")
    assert again.filter("part <> p2").count() == 0
    assert 4000 < so.sample_fraction(df, 0.25, "id").count() < 6000
    texts = df.select(F.concat(F.lit("L"), "id").alias("k"))
    assert 4000 < so.sample_fraction(texts, 0.25, "k").count() < 6000


def test_one_row_per_key_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = wn.dedupe_by_id(df, "k", ["id"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("row_number(), 1, Partial"), plan.index("Exchange hashpartitioning")
    assert plan.index("row_number(), 1, Final") < exchange < partial  # printed from the last step to the first
    assert sorted(rows(wn.dedupe_by_id(df, "k", [F.desc("id")]))) == [(0, 999), (1, 997), (2, 998)]


def test_select_features_drops_what_says_nothing(spark):
    df = spark.createDataFrame([(1, 5, None, None), (2, 5, None, 1)], "a int, b int, c int, d int")
    assert md.select_features(df).columns == ["a", "d"]


def test_best_model_ties_and_eligibility(spark):
    board = spark.createDataFrame([
        ("p", 1, "x", 96.0, "All_trends", 1.0), ("p", 3, "y", 100.0, "All_trends", 5.0),
        ("p", 2, "z", 100.0, "Statical_list", 5.0), ("p", 4, "y", 64.0, "Other", 9.0), ("p", 5, "w", 100.0, "Other", 0.1)],
        "project_name string, model_id int, blueprint_id string, sample_pct double, featurelist_name string, holdout_mape double")
    assert rows(md.pick_best_model(board)) == [("p", 2, 5.0)]
    kept, gone = md.prune_models(board)
    assert {r.model_id for r in kept.collect()} == {2, 3, 4} and {r.model_id for r in gone.collect()} == {1, 5}


def test_segment_names_and_codes(spark):
    names = md.segment_names()
    assert len(names) == 92 and "Grand_rapids_24340, 26090_combined_not_sold" in names
    df = spark.createDataFrame([(12420,), (26090,), (1,), (None,)], "cbsa long")
    assert [r.segment for r in md.segment_by_metro(df, md.METRO_SEGMENTS, "cbsa").collect()] == [
        "Austin", "Grand_rapids", "no_big_ma", "no_big_ma"]


def test_html_and_mail(spark):
    html = ('<div class="a" data-id="1" id=x><style>p{}</style><a href="u">gone</a><p><span> </span></p>'
            '<p title="t">kept<br></p><img src="i"><script>var t="</p>";</script></div>')
    df = spark.createDataFrame([(html,)], "h string")
    assert ot.strip_html(df, "h", "c").first().c == '<div data-id="1"><p>kept<br></p></div>'
    mails = spark.createDataFrame([("From: a\r\nSubject: Hi there\r\n\r\nBody\r\n\r\nmore",), ("just text",)], "m string")
    out = rows(ot.email_subject_body(mails, "m").select("subject", "body"))
    assert out == [("Hi there", "Body\n\nmore"), ("", "just text")]
    text = spark.createDataFrame([("  Café\t“naïve” ß 中 ",)], "t string")
    assert ot.scrub_text(text, "t", "s").first().s == 'Cafe "naive" ss'


def test_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "a"), (3, ""), (4, None)], "id int, t string")
    out = ot.word_ngrams(df, "t", (1, 2, 3))
    assert sorted(rows(out)) == [(1, "a"), (1, "a b"), (1, "a b c"), (1, "b"), (1, "b c"), (1, "c"), (2, "a")]


def test_before_and_after(spark):
    df = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 1)), (date(2023, 1, 1), date(2024, 1, 1)),
                                (date(2023, 1, 1), None)], "d date, t date")
    assert [r.period_indicator for r in kpi.period_indicator(df, "d", "t").collect()] == ["After", "Before", None]
