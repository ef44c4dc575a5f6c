"""Silver build on hand-made rows (the cases of FIXTURES.md section 1)."""

from decimal import Decimal

from pyspark.sql import functions as F

from terrane.functions.scalars import initcap_words, parse_date, parse_decimal
from terrane.plans import silver
from tests.conftest import raw_row

MAISON, DEP, LOCAL = "Maison", "Dépendance", "Local industriel. commercial ou assimilé"


def _silver(src_df, rows, **kw):
    return silver.silver_rows(src_df(rows), already_staged=True, **kw)


def _by_doc(df):
    return {r.identifiant_document: r for r in df.collect()}


def test_decimal_comma_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([("123456,50",), ("-2,5",), ("abc",), (None,), ("1e3",)], ["v"])
    got = [r.p for r in df.select(parse_decimal("v").alias("p")).collect()]
    assert got == [Decimal(123457), Decimal(-3), None, None, Decimal(1000)]


def test_dates_iso_and_day_first_impossible_is_null(spark):
    df = spark.createDataFrame([("2021-03-15",), ("15/03/2021",), ("31/02/2021",), (None,)], ["d"])
    got = [str(r.p) if r.p else None for r in df.select(parse_date("d").alias("p")).collect()]
    assert got == ["2021-03-15", "2021-03-15", None, None]


def test_price_rules_by_type(src_df):
    rows = [
        raw_row(identifiant_document="bad", valeur_fonciere="abc", type_local=MAISON),
        raw_row(identifiant_document="zero", valeur_fonciere="0", type_local=MAISON),
        raw_row(identifiant_document="neg", valeur_fonciere="-5", type_local=MAISON),
        raw_row(identifiant_document="null", valeur_fonciere=None, type_local=MAISON),
        raw_row(identifiant_document="m8", valeur_fonciere="1000", type_local=MAISON, surface_reelle_bati="8"),
        raw_row(identifiant_document="m9", valeur_fonciere="1000", type_local=MAISON, surface_reelle_bati="9"),
        raw_row(identifiant_document="mnull", valeur_fonciere="1000", type_local=MAISON),
        raw_row(identifiant_document="m999", valeur_fonciere="999", type_local=MAISON),
        raw_row(identifiant_document="d499", valeur_fonciere="499", type_local=DEP),
        raw_row(identifiant_document="d500", valeur_fonciere="500", type_local=DEP),
        raw_row(identifiant_document="l4", valeur_fonciere="1000", type_local=LOCAL, surface_reelle_bati="4"),
        raw_row(identifiant_document="l5", valeur_fonciere="1000", type_local=LOCAL, surface_reelle_bati="5"),
        raw_row(identifiant_document="n999", valeur_fonciere="999"),
        raw_row(identifiant_document="n1000", valeur_fonciere="1000"),
    ]
    kept = set(_by_doc(_silver(src_df, rows)))
    assert kept == {"m9", "mnull", "d500", "l5", "n1000"}


def test_exact_duplicate_is_one_row_and_lots_are_ranked(src_df):
    base = dict(no_disposition="1", identifiant_document="D", valeur_fonciere="5000", type_local=MAISON,
                surface_reelle_bati="50")
    rows = [
        raw_row(**base, commune="A"), raw_row(**base, commune="A"),      # exact duplicate
        raw_row(**base, commune="B"), raw_row(**base, commune="C"),      # same key, other columns differ
    ]
    out = _silver(src_df, rows).select("commune", "mutation_id").collect()
    assert len(out) == 3
    assert len({r.mutation_id for r in out}) == 3


def test_rows_differing_only_in_reference_get_ranks_1_2(src_df):
    from terrane.operators.windows import rank_distinct_rows
    base = dict(no_disposition="1", identifiant_document="D", valeur_fonciere="5000", type_local=MAISON)
    df = silver.clean_projection(src_df([raw_row(**base, reference_document="r1"),
                                         raw_row(**base, reference_document="r2")]))
    ranks = sorted(r.lot_rank for r in rank_distinct_rows(df, silver.rank_key(), silver.RAW_CODE, "lot_rank").collect())
    assert ranks == [1, 2]


def test_null_and_empty_type_share_a_rank_group(src_df):
    from terrane.operators.windows import rank_distinct_rows
    base = dict(no_disposition="1", identifiant_document="D", valeur_fonciere="5000")
    df = silver.clean_projection(src_df([raw_row(**base, type_local=None), raw_row(**base, type_local="")]))
    ranks = sorted(r.lot_rank for r in rank_distinct_rows(df, silver.rank_key(), silver.RAW_CODE, "lot_rank").collect())
    assert ranks == [1, 2]


def test_hot_key_salting_gives_the_same_ranks(src_df):
    from terrane.operators.windows import rank_distinct_rows
    rows = [raw_row(no_disposition="1", identifiant_document="HOT", valeur_fonciere=str(1000 + i),
                    type_local=MAISON, surface_reelle_bati="50", commune=f"c{i % 7}") for i in range(300)]
    rows += [raw_row(no_disposition="2", identifiant_document=f"d{i}", valeur_fonciere="2000") for i in range(50)]
    rows += rows[:40]  # duplicates inside the hot key
    df = silver.clean_projection(src_df(rows))
    plain = {(r.raw_code, r.lot_rank) for r in
             rank_distinct_rows(df, silver.rank_key(), silver.RAW_CODE, "lot_rank", hot_threshold=None).collect()}
    split = {(r.raw_code, r.lot_rank) for r in
             rank_distinct_rows(df, silver.rank_key(), silver.RAW_CODE, "lot_rank", hot_threshold=7).collect()}
    assert plain == split
    assert len(plain) == 350


def test_window_operator_salting_matches_plain(spark):
    from terrane.operators.windows import rank_within_key
    rows = [("k", f"{i:04d}") for i in range(500)] + [("j", f"{i:04d}") for i in range(5)]
    df = spark.createDataFrame(rows, ["k", "v"])
    spread = F.md5("v")
    plain = {tuple(r) for r in rank_within_key(df, ["k"], ["v"], "r", spread=spread, hot_threshold=None).collect()}
    split = {tuple(r) for r in rank_within_key(df, ["k"], ["v"], "r", spread=spread, hot_threshold=13).collect()}
    assert plain == split


def test_keep_first_per_key(src_df):
    base = dict(no_disposition="1", identifiant_document="D", valeur_fonciere="5000", type_local=MAISON)
    rows = [raw_row(**base, commune=c) for c in ("x", "y", "z")]
    assert _silver(src_df, rows, first_only=True).count() == 1


def test_lower_case_with_accents_and_unit_price(src_df):
    rows = [
        raw_row(identifiant_document="a", valeur_fonciere="1000", type_local="DÉPENDANCE", surface_terrain="20",
                nature_mutation="Échange"),
        raw_row(identifiant_document="b", valeur_fonciere="1000", type_local="Dépendance", surface_terrain="0"),
        raw_row(identifiant_document="c", valeur_fonciere="100000", type_local=MAISON, surface_reelle_bati="50"),
    ]
    got = _by_doc(_silver(src_df, rows))
    assert got["a"].type_local == "dépendance" and got["a"].nature_mutation == "échange"
    assert got["a"].prix_metre_carre == 50.0
    assert got["b"].prix_metre_carre is None
    assert got["c"].prix_metre_carre == 2000.0


def test_ids_do_not_depend_on_partitioning(spark, src_df):
    rows = [raw_row(no_disposition=str(i % 3), identifiant_document=str(i % 17), valeur_fonciere=str(1000 + i),
                    commune=f"c{i % 5}", type_local=MAISON if i % 2 else None) for i in range(400)]
    ids = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        ids.append(sorted(r.mutation_id for r in _silver(src_df, rows).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert ids[0] == ids[1]


def test_initcap_breaks_on_punctuation_not_apostrophe(spark):
    df = spark.createDataFrame([("sol-bâti. été",), ("vente en l'état",), (None,)], ["t"])
    got = [r.x for r in df.select(initcap_words("t").alias("x")).collect()]
    assert got == ["Sol-Bâti. Été", "Vente En L'état", None]


def test_date_key_and_null(spark):
    import datetime as dt

    from terrane.functions.scalars import date_key
    df = spark.createDataFrame([(dt.date(2021, 3, 15),), (None,)], "d date")
    assert [r.k for r in df.select(date_key("d").alias("k")).collect()] == [20210315, None]


def test_silver_build_same_with_forced_salting(src_df):
    rows = [raw_row(no_disposition=str(i % 2), identifiant_document=str(i % 5), valeur_fonciere=str(1000 + i % 37),
                    commune=f"c{i % 3}", type_local=MAISON if i % 2 else None, date_mutation="2021-01-0" + str(1 + i % 9))
            for i in range(300)]
    plain = sorted(tuple(r) for r in _silver(src_df, rows, hot_threshold=None).collect())
    salted = sorted(tuple(r) for r in _silver(src_df, rows, hot_threshold=3).collect())
    assert plain == salted and len(plain) > 0


def test_session_knobs_force_the_split_paths(spark, src_df):
    from terrane.plans import gold
    rows = [raw_row(no_disposition="1", identifiant_document=str(i % 4), valeur_fonciere=str(1000 + i),
                    commune=f"c{i % 3}", type_local=MAISON, date_mutation="2021-02-03") for i in range(120)]
    plain = sorted(tuple(r) for r in _silver(src_df, rows, hot_threshold=None).collect())
    med_plain = sorted(tuple(r) for r in gold.avg_median_by_group(_silver(src_df, rows)).collect())
    for knobs in ({"terrane.hotKeyRows": "2"}, {"terrane.hotKeyRows": "2", "terrane.hotKeyList": "1"}):
        for k, v in knobs.items():
            spark.conf.set(k, v)
        try:  # heavy keys split, with their salts broadcast and joined by shuffle
            assert sorted(tuple(r) for r in _silver(src_df, rows).collect()) == plain
            assert sorted(tuple(r) for r in gold.avg_median_by_group(_silver(src_df, rows)).collect()) == med_plain
        finally:
            for k in knobs:
                spark.conf.unset(k)


def test_incremental_lookback_adds_late_rows_once(spark, src_df):
    from terrane.session import scratch_dir
    first = [raw_row(no_disposition="1", identifiant_document=f"d{i}", valeur_fonciere="5000", type_local=MAISON,
                     date_mutation=f"2021-01-{i:02d}") for i in range(1, 11)]
    late = raw_row(no_disposition="1", identifiant_document="late", valeur_fonciere="7000", type_local=MAISON,
                   date_mutation="2021-01-09")
    strict_root, lookback_root = scratch_dir(spark, "t-strict"), scratch_dir(spark, "t-lookback")
    for root in (strict_root, lookback_root):
        silver.incremental_build(src_df(first), root, already_staged=True)
    strict = silver.incremental_build(src_df(first + [late]), strict_root, already_staged=True)
    assert "late" not in {r.identifiant_document for r in strict.collect()}
    back = silver.incremental_build(src_df(first + [late]), lookback_root, already_staged=True, lookback_days=5)
    docs = [r.identifiant_document for r in back.collect()]
    assert "late" in docs and len(docs) == 11 and len(set(docs)) == 11


def test_lookback_replaces_reopened_keys_without_duplicates(spark, src_df):
    """Late rows shift the ranks of their key: its stored rows are replaced, not kept beside the new ones."""
    from terrane.session import scratch_dir
    key = dict(no_disposition="1", identifiant_document="D", type_local=MAISON, surface_reelle_bati="50")
    sale = lambda i, day: raw_row(**key, valeur_fonciere=str(5000 + i), commune=f"c{i}", date_mutation=day)
    old = [sale(i, "2021-02-10") for i in range(4)] + [raw_row(no_disposition="9", identifiant_document="other", valeur_fonciere="6000",
                                                               type_local=MAISON, date_mutation="2020-11-03")]
    late = [sale(i, "2021-01-20") for i in range(4, 8)]
    root = scratch_dir(spark, "t-late")
    silver.incremental_build(src_df(old), root, already_staged=True)
    out = silver.incremental_build(src_df(old + late), root, already_staged=True, lookback_days=30)
    assert sorted(tuple(r) for r in out.collect()) == sorted(tuple(r) for r in silver.silver_rows(src_df(old + late), True).collect())
    again = silver.incremental_build(src_df(old + late), root, already_staged=True, lookback_days=30)
    assert again.count() == 9


def test_building_the_plan_runs_no_job(spark, src_df):
    from terrane.operators.windows import rank_within_key
    df = src_df([raw_row(identifiant_document=f"d{i % 3}", valeur_fonciere=str(i)) for i in range(60)])
    sc = spark.sparkContext
    sc.setJobGroup("plan-only", "")
    try:
        silver.silver_rows(df, already_staged=True, hot_threshold=5)
        rank_within_key(df, ["identifiant_document"], ["valeur_fonciere"], spread=F.md5("valeur_fonciere"), hot_threshold=5)
        assert sc.statusTracker().getJobIdsForGroup("plan-only") == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_only_raw_columns_are_shuffled_to_be_ranked(spark, src_df):
    df = src_df([raw_row(identifiant_document=str(i), no_disposition="1", valeur_fonciere="5000") for i in range(3)])
    plan = silver.silver_rows(df, already_staged=True)._jdf.queryExecution().optimizedPlan().toString()
    main = plan.split("RepartitionByExpression", 1)[1].split("Join LeftOuter", 1)
    assert "RepartitionByExpression [__p" in plan
    assert "__code" not in main[0] and "__h" not in main[0] and "cle_" not in main[0]


def test_a_format_is_tried_only_where_its_separators_are(spark):
    df = spark.createDataFrame([("15/03/2021",), ("2021-03-15",), ("15.03.2021",), ("",), (None,)], ["d"])
    got = [str(r.p) if r.p else None for r in df.select(parse_date("d").alias("p")).collect()]
    assert got == ["2021-03-15", "2021-03-15", None, None, None]
    plan = df.select(parse_date("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert "when contains(d" in plan.lower()


def test_first_per_key_carries_no_column_twice(spark):
    from terrane.operators.windows import keep_first_per_key
    df = spark.createDataFrame([("a", "2", 1.0), ("a", "1", 2.0), (None, "3", 3.0), (None, "3", 2.5)], "k string, o string, v double")
    first = keep_first_per_key(df, ["k"], ["o"])
    assert first.columns == ["k", "o", "v"]
    assert sorted(map(tuple, first.collect()), key=str) == sorted([("a", "1", 2.0), (None, "3", 2.5)], key=str)
    carried = first._jdf.queryExecution().optimizedPlan().toString().split("min(struct(", 1)[1].split(")")[0]
    assert ", k," not in carried and ", o," not in carried


def test_a_key_column_is_sorted_once_and_tasks_follow_the_rows(spark, src_df):
    raw = [raw_row(identifiant_document=str(i % 7), no_disposition=None if i % 5 == 0 else "1", valeur_fonciere=str(5000 + i % 11)) for i in range(90)]
    df = src_df(raw)
    want = sorted(map(tuple, silver.silver_rows(df, already_staged=True).collect()), key=str)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("terrane.taskRows", "2")
    try:
        out = silver.silver_rows(df, already_staged=True, n_rows=2 * (parts + 3))
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert sorted(map(tuple, out.collect()), key=str) == want
    finally:
        spark.conf.unset("terrane.taskRows")
    assert f", {parts + 3}" in plan.split("RepartitionByExpression", 1)[1].splitlines()[0]
    ranked = plan.split("dense_rank(", 1)[1].split("windowspecdefinition(", 1)[1].splitlines()[0]
    assert "identifiant_document#" in ranked and "__k0" not in ranked and "__k1" not in ranked


def test_a_new_batch_is_ranked_without_an_exact_join_of_its_keys(spark, src_df):
    from terrane.session import scratch_dir, scratch_scope
    old = [raw_row(identifiant_document=f"d{i}", date_mutation="2021-01-05", valeur_fonciere=str(5000 + i)) for i in range(40)]
    new = [raw_row(identifiant_document=f"d{i}", date_mutation="2021-02-05", valeur_fonciere=str(7000 + i)) for i in range(20, 60)]
    root = scratch_dir(spark, "t-strict")
    silver.incremental_build(src_df(old), root, already_staged=True)
    with scratch_scope() as made:
        out = silver.incremental_build(src_df(old + new), root, already_staged=True)
        assert not any("silver-open-keys" in p for p in made)
        whole = silver.silver_rows(src_df(old + new), True).filter("date_mutation > DATE'2021-01-05'").collect()
        assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, silver.silver_rows(src_df(old), True).collect() + whole), key=str)


def _lots(src_df):
    """Distinct and repeated rows of light and heavy lot keys, NULLs among them."""
    rows = [raw_row(no_disposition="1", identifiant_document="HOT", type_local=MAISON, valeur_fonciere=str(1000 + i)) for i in range(200)]
    rows += [raw_row(no_disposition=str(i % 3), identifiant_document=None if i % 9 == 0 else f"d{i % 20}", type_local=["", None, DEP][i % 3],
                     surface_reelle_bati=[None, "4", "4,2"][i % 3], valeur_fonciere=str(i)) for i in range(90)]
    return src_df(rows + rows[:40] + rows[200:230])


def _dealt_lots(src_df, threshold, n_rows=0):
    from terrane.operators.windows import DEALT, dealt_by_key, row_code
    rows = dealt_by_key(_lots(src_df), silver.raw_rank_key(), F.md5(row_code(silver.SRC_COLUMNS)), threshold, n_rows)
    return silver.clean_projection(rows.distinct(), keep=DEALT)


def test_first_of_a_key_shares_the_shuffle_of_the_distinct_rows(spark, src_df):
    from terrane.operators.windows import keep_first_per_key
    plain = keep_first_per_key(silver.clean_projection(_lots(src_df).distinct()), silver.rank_key(), silver.rank_order())
    want = sorted(map(tuple, plain.collect()), key=str)
    assert len(want) == plain.select(*silver.rank_key()).distinct().count()
    for threshold in (None, 1, 7):
        first = keep_first_per_key(_dealt_lots(src_df, threshold), silver.rank_key(), silver.rank_order())
        assert first.columns == plain.columns
        assert sorted(map(tuple, first.collect()), key=str) == want
    light = first._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1].split("\n   :- ", 1)[1].split("\n   +- ", 1)[0]
    assert light.count("Exchange hashpartitioning(") == 1


def test_ranks_share_the_shuffle_of_the_distinct_rows(spark, src_df):
    from terrane.operators.windows import rank_within_key
    spread, by = F.md5(silver.RAW_CODE), [F.col(silver.RAW_CODE)]
    plain = rank_within_key(silver.clean_projection(_lots(src_df).distinct()), silver.rank_key(), by, "r", spread=spread)
    want = sorted(map(tuple, plain.collect()), key=str)
    for threshold in (None, 1, 7):
        ranked = rank_within_key(_dealt_lots(src_df, threshold, 90), silver.rank_key(), by, "r", spread=spread, hot_threshold=threshold)
        assert ranked.columns == plain.columns
        assert sorted(map(tuple, ranked.collect()), key=str) == want
    plan = ranked.select("*")._jdf.queryExecution().executedPlan().toString()
    numbered = plan.split("Window [row_number()", 1)[1].split("BroadcastExchange", 1)[0]
    assert numbered.count("Exchange hashpartitioning(") == 1
