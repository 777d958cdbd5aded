"""Dimension merge: each rule on literal cases, then random change logs
against the sequential reference, in one batch and in several, with and
without hot-key chunking."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from scd2_reference import FoldState, fold_batch, versions
from starling.operators.scd2 import CUSTOMER_DIM, empty_dimension, empty_tombstones, scd2_merge
from starling.sinks.dimension_store import DimensionStore

COLS = ["cdc_operation", "customer_id", "cust_email", "cust_phone", "cust_address", "cust_country", "cust_city",
        "hash_value", "cust_first_name", "cust_last_name", "dms_timestamp"]


def changes_df(spark, rows):
    """rows: (op, key, hash, ts[, email])"""
    recs = []
    for r in rows:
        op, key, h, ts = r[:4]
        email = r[4] if len(r) > 4 else f"{key}@x"
        recs.append((op, key, email, h, "addr", "country", "city", h, "First", "Last", ts))
    pdf = pd.DataFrame(recs, columns=COLS)
    return spark.createDataFrame(pdf).withColumn("dms_timestamp", F.col("dms_timestamp").cast("timestamp"))


def dim_rows(result, cols=("customer_id", "hash_value", "cust_email")):
    df = result.dimension().select(*cols, F.date_format("record_start_ts", "HH:mm").alias("s"),
                                   F.date_format("record_end_ts", "yyyy").alias("e"), "active_flag")
    return sorted(tuple(r) for r in df.collect())


def merge(spark, rows, spec=CUSTOMER_DIM, **kw):
    return scd2_merge(empty_dimension(spark, spec), empty_tombstones(spark, spec), changes_df(spark, rows), spec, **kw)


def t(m):
    return f"2024-01-01 00:{m:02d}:00"


def test_insert_then_same_hash_update_is_one_version(spark):
    r = merge(spark, [("I", "k", "h1", t(1)), ("U", "k", "h1", t(2))])
    assert dim_rows(r) == [("k", "h1", "k@x", "00:01", "9999", 1)]


def test_changed_hash_closes_and_opens(spark):
    r = merge(spark, [("I", "k", "h1", t(1)), ("U", "k", "h2", t(2))])
    assert dim_rows(r) == [("k", "h1", "k@x", "00:01", "2024", 0), ("k", "h2", "k@x", "00:02", "9999", 1)]


def test_insert_delete_insert_same_hash_gives_two_versions(spark):
    r = merge(spark, [("I", "k", "h1", t(1)), ("D", "k", "h1", t(2)), ("I", "k", "h1", t(3))])
    assert dim_rows(r) == [("k", "h1", "k@x", "00:01", "2024", 0), ("k", "h1", "k@x", "00:03", "9999", 1)]
    assert r.tombstones.count() == 0


def test_delete_of_unknown_key_does_nothing(spark):
    r = merge(spark, [("D", "k", "h1", t(1))])
    assert r.dimension().count() == 0 and r.tombstones.count() == 0


def test_delete_leaves_tombstone(spark):
    r = merge(spark, [("I", "k", "h1", t(1)), ("D", "k", "h1", t(5))])
    assert [tuple(x) for x in r.tombstones.select("customer_id", F.date_format("deleted_ts", "HH:mm")).collect()] \
        == [("k", "00:05")]
    assert r.active.count() == 0


def test_ties_collapse_by_op_then_hash(spark):
    # same key, same time: D beats U beats I
    r = merge(spark, [("I", "a", "h1", t(1)), ("U", "a", "h2", t(2)), ("D", "a", "h3", t(2))])
    assert dim_rows(r) == [("a", "h1", "a@x", "00:01", "2024", 0)]
    # equal op: the larger hash wins
    r = merge(spark, [("I", "b", "h1", t(1)), ("I", "b", "h9", t(1))])
    assert dim_rows(r) == [("b", "h9", "b@x", "00:01", "9999", 1)]


def test_type1_email_takes_last_value_of_run(spark):
    spec = CUSTOMER_DIM.with_type1("cust_email")
    rows = [("I", "k", "h1", t(1), "e1"), ("U", "k", "h1", t(2), "e2"), ("U", "k", "h2", t(3), "e3"),
            ("U", "k", "h2", t(4), "e4")]
    r = merge(spark, rows, spec)
    assert dim_rows(r) == [("k", "h1", "e2", "00:01", "2024", 0), ("k", "h2", "e4", "00:03", "9999", 1)]
    # type 1 off: the email of the change that opened the version
    r = merge(spark, rows)
    assert dim_rows(r) == [("k", "h1", "e1", "00:01", "2024", 0), ("k", "h2", "e3", "00:03", "9999", 1)]


def test_late_change_is_reported_not_applied(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
    store.apply(changes_df(spark, [("I", "k", "h1", t(5)), ("I", "j", "h1", t(5)), ("D", "j", "h1", t(6))]), 0)
    store.apply(changes_df(spark, [("U", "k", "h2", t(3)), ("U", "j", "h2", t(6)), ("U", "k", "h3", t(7))]), 1)
    late = sorted((r.customer_id, r.hash_value) for r in store.late().collect())
    assert late == [("j", "h2"), ("k", "h2")]
    got = sorted((r.customer_id, r.hash_value, r.active_flag) for r in store.dimension().collect())
    assert got == [("j", "h1", 0), ("k", "h1", 0), ("k", "h3", 1)]


def test_null_change_time_goes_to_late(spark):
    r = merge(spark, [("I", "k", "h1", None)])
    assert r.late.count() == 1 and r.dimension().count() == 0


def _random_log(seed, n_keys=12, n=160, minutes=40):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        k = f"k{rnd.randrange(n_keys)}"
        op = rnd.choices(["I", "U", "D"], weights=[3, 5, 2])[0]
        out.append((op, k, f"h{rnd.randrange(3)}", t(rnd.randrange(minutes)), f"e{rnd.randrange(4)}"))
    # one hot key, so the chunked path has real work
    for m in range(40):
        out.append((rnd.choice("IUUD"), "hot", f"h{rnd.randrange(2)}", t(m % minutes), f"e{rnd.randrange(4)}"))
    rnd.shuffle(out)
    return out


def _fold(batches, type1=()):
    st = FoldState()
    rest = ["cdc_operation", "cust_email", "cust_phone", "cust_address", "cust_country", "cust_city",
            "cust_first_name", "cust_last_name"]
    rest = [c for c in rest if c not in type1]
    for b in batches:
        recs = [{"op": op, "customer_id": k, "hash_value": h, "ts": ts, "cust_email": e, "cdc_operation": op,
                 "cust_phone": h, "cust_address": "addr", "cust_country": "country", "cust_city": "city",
                 "cust_first_name": "First", "cust_last_name": "Last"} for op, k, h, ts, e in b]
        fold_batch(st, recs, "customer_id", "hash_value", rest, type1)
    return st


@pytest.mark.parametrize("seed,max_group_rows,type1", [(1, 1_000_000, ()), (2, 4, ()), (3, 4, ("cust_email",))])
def test_random_logs_match_sequential_fold(spark, tmp_root, seed, max_group_rows, type1):
    log = _random_log(seed)
    cut1, cut2 = len(log) // 3, 2 * len(log) // 3
    batches = [log[:cut1], log[cut1:cut2], log[cut2:]]
    spec = CUSTOMER_DIM.with_type1(*type1)
    st = _fold(batches, type1)
    want = versions(st, ["customer_id", "hash_value", "cust_email", "cdc_operation"])
    want = sorted((*w[:4], w[4][11:16], w[5][:4], w[6]) for w in want)

    store = DimensionStore(spark, tmp_root, spec)
    for i, b in enumerate(batches):
        store.apply(changes_df(spark, b), i, max_group_rows=max_group_rows)
    got = sorted(
        tuple(r) for r in store.dimension().select(
            "customer_id", "hash_value", "cust_email", "cdc_operation",
            F.date_format("record_start_ts", "HH:mm"), F.date_format("record_end_ts", "yyyy"), "active_flag",
        ).collect()
    )
    assert got == want
    late = sorted((r.customer_id, r.hash_value, r.t) for r in store.late().select(
        "customer_id", "hash_value", F.date_format("dms_timestamp", "HH:mm").alias("t")).collect())
    assert late == sorted((c["customer_id"], c["hash_value"], c["ts"][11:16]) for c in st.late)
    tombs = sorted((r.customer_id, r.t) for r in store.state(store.last_committed())[1].select(
        "customer_id", F.date_format("deleted_ts", "HH:mm").alias("t")).collect())
    assert tombs == sorted((k, v[11:16]) for k, v in st.tombstones.items())
    # invariants: one open version per key; open <=> end 9999-12-31
    dim = store.dimension()
    assert dim.groupBy("customer_id").agg(F.sum("active_flag").alias("n")).where("n > 1").count() == 0
    assert dim.where((F.col("active_flag") == 1) != (F.year("record_end_ts") == 9999)).count() == 0


def test_one_batch_equals_many_batches(spark, tmp_root):
    """Batches cut at time boundaries (no late changes) give the same
    dimension as one batch: the merge is independent of batching."""
    log = sorted(_random_log(7), key=lambda r: r[3])
    times = sorted({r[3] for r in log})
    edges = [times[len(times) * i // 4] for i in range(1, 4)]
    batches = [[r for r in log if (i == 0 or r[3] >= edges[i - 1]) and (i == 3 or r[3] < edges[i])]
               for i in range(4)]
    assert sum(map(len, batches)) == len(log)
    one = merge(spark, log, max_group_rows=5)
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
    for i, b in enumerate(batches):
        store.apply(changes_df(spark, b), i, max_group_rows=5)
    cols = ["customer_id", "hash_value", "record_start_ts", "record_end_ts", "active_flag"]
    a = sorted(tuple(r) for r in one.dimension().select(*cols).collect())
    b = sorted(tuple(r) for r in store.dimension().select(*cols).collect())
    assert a == b and len(a) > 0
    assert store.late().count() == 0


def test_replayed_batch_is_harmless(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
    b0 = changes_df(spark, [("I", "k", "h1", t(1)), ("I", "j", "h1", t(1))])
    b1 = changes_df(spark, [("U", "k", "h2", t(2)), ("D", "j", "h1", t(3))])
    store.apply(b0, 0)
    store.apply(b1, 1)
    first = sorted(tuple(r) for r in store.dimension().collect())
    store.apply(b1, 1)  # replay of the last batch
    assert sorted(tuple(r) for r in store.dimension().collect()) == first
    assert store.late().count() == 0


def test_uncommitted_batch_is_invisible(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
    store.apply(changes_df(spark, [("I", "k", "h1", t(1))]), 0)
    # a crash after the data write but before the commit marker
    r = scd2_merge(*store.state(0), changes_df(spark, [("U", "k", "h2", t(2))]), CUSTOMER_DIM)
    store.write(r, 1)
    assert store.last_committed() == 0
    assert [r.hash_value for r in store.dimension().collect()] == ["h1"]


def test_vacuum_keeps_history_and_newest_state(spark, tmp_root):
    store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
    for i in range(4):
        store.apply(changes_df(spark, [("U", "k", f"h{i}", t(i + 1))]), i)
    before = sorted(tuple(r) for r in store.dimension().collect())
    removed = store.vacuum(keep=2)
    assert len(removed) == 2 and all("part=active" in p or "part=tombstones" in p for p in removed)
    assert sorted(tuple(r) for r in store.dimension().collect()) == before
    store.apply(changes_df(spark, [("U", "k", "h9", t(9))]), 4)
    assert store.dimension().where("active_flag = 1").first().hash_value == "h9"


def test_bucket_count_follows_active_size_and_survives_restart(spark, tmp_root):
    """Buckets grow with the stored active set; a new application (catalog
    definitions gone) re-declares each batch with its recorded layout."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2k")
    try:
        log = sorted(_random_log(11, n_keys=60, n=600), key=lambda r: r[3])
        parts = [log[:200], log[200:400], log[400:]]
        store = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
        store.apply(changes_df(spark, parts[0]), 0)
        store.apply(changes_df(spark, parts[1]), 1)
        assert store._layout(1) > store._layout(0)
        for t in spark.catalog.listTables():
            if t.name.startswith(store.prefix):
                spark.sql(f"DROP TABLE IF EXISTS `{t.name}`")
        fresh = DimensionStore(spark, tmp_root, CUSTOMER_DIM)
        fresh.apply(changes_df(spark, parts[2]), 2)
        cols = ["customer_id", "hash_value", "record_start_ts", "record_end_ts", "active_flag"]
        got = sorted(tuple(r) for r in fresh.dimension().select(*cols).collect())
        st = _fold(parts)
        want = sorted((w[0], w[1], w[4][11:16], w[5][:4], w[6])
                      for w in versions(st, ["customer_id", "hash_value", "cust_email", "cdc_operation"]))
        got = sorted((a, b, str(c)[11:16], str(d)[:4], e) for a, b, c, d, e in got)
        assert got == want
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


from hypothesis import given, settings, HealthCheck, strategies as st  # noqa: E402

_change = st.tuples(st.sampled_from("IUD"), st.sampled_from(["a", "b", "c"]), st.sampled_from(["h0", "h1", "h2"]),
                    st.integers(0, 8), st.sampled_from(["e0", "e1"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(log=st.lists(_change, min_size=1, max_size=24), chunked=st.booleans())
def test_generated_logs_match_fold(spark, log, chunked):
    rows = [(op, k, h, t(m), e) for op, k, h, m, e in log]
    r = merge(spark, rows, max_group_rows=2 if chunked else 1_000_000)
    got = sorted((x.customer_id, x.hash_value, x.cust_email, x.s, x.e, x.active_flag) for x in r.dimension().select(
        "customer_id", "hash_value", "cust_email", F.date_format("record_start_ts", "HH:mm").alias("s"),
        F.date_format("record_end_ts", "yyyy").alias("e"), "active_flag").collect())
    st_ = _fold([rows])
    want = sorted((w[0], w[1], w[2], w[3][11:16], w[4][:4], w[5])
                  for w in versions(st_, ["customer_id", "hash_value", "cust_email"]))
    assert got == want
    tombs = sorted((x.customer_id, x.t) for x in r.tombstones.select(
        "customer_id", F.date_format("deleted_ts", "HH:mm").alias("t")).collect())
    assert tombs == sorted((k, v[11:16]) for k, v in st_.tombstones.items())


# ---------------------------------------------------------------- hot keys
def _updates(spark, rows):
    """(key, minute, op, hash, email) as silver customer changes."""
    from datetime import datetime, timedelta

    from pyspark.sql import functions as F

    from starling.operators.scd2 import CUSTOMER_DIM

    base = datetime(2024, 1, 1)
    df = spark.createDataFrame([(k, None if t is None else base + timedelta(minutes=t), op, h, e) for k, t, op, h, e in rows],
                               "customer_id string, dms_timestamp timestamp, cdc_operation string, hash_value string, cust_email string")
    have = set(df.columns)
    return df.select("dms_timestamp", *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                                        for f in CUSTOMER_DIM.schema.fields])


def _merged(spark, rows, limit, spec):
    from starling.operators.scd2 import empty_dimension, empty_tombstones, scd2_merge

    r = scd2_merge(empty_dimension(spark, spec), empty_tombstones(spark, spec), _updates(spark, rows), spec, max_group_rows=limit)
    return r, sorted(tuple(map(str, x)) for x in r.dimension().select(
        "customer_id", "hash_value", "cust_email", "record_start_ts", "record_end_ts").collect())


def test_type1_survives_chunks_without_a_kept_event(spark):
    from starling.operators.scd2 import CUSTOMER_DIM

    spec = CUSTOMER_DIM.with_type1("cust_email")
    rows = [("k", 0, "I", "h", "e0")] + [("k", i, "U", "h", f"e{i}") for i in range(1, 20)]
    whole, chunked = _merged(spark, rows, 1_000_000, spec)[1], _merged(spark, rows, 4, spec)[1]
    assert whole == chunked and whole[0][2] == "e19"


def test_chunked_equals_whole_with_long_runs_of_one_hash(spark):
    import random

    from starling.operators.scd2 import CUSTOMER_DIM

    spec, rnd = CUSTOMER_DIM.with_type1("cust_email"), random.Random(4)
    rows = []
    for k in ("a", "b"):
        for i in range(80):
            op = rnd.choice(["U"] * 9 + ["D"])
            rows.append((k, rnd.randrange(60), op, f"h{rnd.randrange(12) // 10}", f"e{i}"))
    assert _merged(spark, rows, 1_000_000, spec)[1] == _merged(spark, rows, 7, spec)[1]


def test_quantile_cuts_bound_every_chunk(spark):
    from pyspark.sql import functions as F

    from starling.operators.scd2 import quantile_cuts

    rows = [("out", -3_000_000)] + [("out", i) for i in range(1000)] + [("few", i) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, m long").select("k", F.timestamp_micros(F.col("m") * 1_000_000).alias("t"))
    cuts = quantile_cuts(df, "k", "t", 50)
    assert [r["k"] for r in cuts.collect()] == ["out"]
    sizes = (df.join(cuts, "k").withColumn("c", F.size(F.filter("_cuts", lambda c: c < F.unix_micros("t"))))
             .groupBy("c").count().collect())
    assert max(r["count"] for r in sizes) <= 100 and len(sizes) >= 15


def test_one_timestamp_collapses_before_chunking(spark):
    from starling.operators.scd2 import CUSTOMER_DIM

    rows = [("k", 5, "U", f"h{i:04d}", "e") for i in range(400)] + [("k", 6, "U", "z", "e")]
    _, got = _merged(spark, rows, 20, CUSTOMER_DIM)
    assert [g[1] for g in got] == ["h0399", "z"]


def test_null_key_is_late(spark):
    from starling.operators.scd2 import CUSTOMER_DIM

    r, got = _merged(spark, [(None, 1, "I", "h", "e"), ("k", 1, "I", "h", "e"), ("k", None, "U", "x", "e")], 1_000_000, CUSTOMER_DIM)
    assert len(got) == 1 and r.late.count() == 2


def test_hot_key_meets_its_boundary_without_a_heavy_task(spark):
    """A key that holds a third of the changes (all but equal rows of it
    included), every key with state: no task above twice the median."""
    from starling.operators.scd2 import with_bounds

    n, keep = 60_000, {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled",
                                                      "spark.sql.autoBroadcastJoinThreshold")}
    chg = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 4000)).alias("key"),
        F.timestamp_seconds(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id"))).alias("_ts"))
    stats = chg.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    bounds = chg.groupBy("key").agg(F.min("_ts").alias("_b")).where("key != 'k1'")
    try:
        for k, v in zip(keep, ("8", "false", "-1")):  # no help from AQE or from small tables
            spark.conf.set(k, v)

        def tasks(df):  # the boundary is used, or the join would be left out
            per = df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("_b"))
            return sorted(r.n for r in per.collect())

        got = tasks(with_bounds(chg, bounds, stats, "key", 1000))
        assert sum(got) == n and got[-1] <= 2 * got[len(got) // 2]
        assert tasks(chg.join(bounds, "key", "left"))[-1] > n / 3
        # many hot keys too, and none at all
        want = chg.join(bounds, "key", "left").select("key", "_ts", "_b")
        for limit in (15, n):
            r = with_bounds(chg, bounds, stats, "key", limit)
            assert r.exceptAll(want).isEmpty() and want.exceptAll(r).isEmpty()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def test_hot_key_with_state_equals_whole(spark):
    """Late, tied and new changes of a hot key upon stored versions and tombstones."""
    first = [("I", "a", "h0", t(1)), ("I", "b", "h0", t(1)), ("D", "b", "h0", t(3)), ("I", "x", "h0", t(1))]
    later = [("U", k, f"h{i % 5}", t(i // 2), f"e{i}") for i in range(80) for k in ("a", "b")]
    later += [("U", k, "h9", t(9)) for k in ("c", "d")]
    state = merge(spark, first)

    def parts(limit):
        r = scd2_merge(state.active, state.tombstones, changes_df(spark, later), CUSTOMER_DIM, max_group_rows=limit)
        return {p: sorted(map(str, getattr(r, p).collect())) for p in ("active", "closed", "late", "tombstones")}

    whole = parts(1_000_000)
    assert len(whole["late"]) > 4 and whole["closed"] and parts(10) == whole


@pytest.fixture()
def checkpointed(spark, monkeypatch):
    """Keys of the rows of each frame that was checkpointed (None without rows)."""
    seen, own = [], type(spark.range(1)).checkpoint

    def checkpoint(df, eager=True):
        out = own(df, eager)
        seen.append(out.select("customer_id").collect())
        return out

    monkeypatch.setattr(type(spark.range(1)), "checkpoint", checkpoint)
    return seen


def _hot_and_others():
    """A hot key of 200 changes at 40 times, and 100 keys of two changes."""
    rows = [("U", "hot", f"h{i % 7}", t(i % 40), f"e{i}") for i in range(200)]
    return rows + [("U", f"k{i % 100}", f"h{i // 100}", t(i // 100)) for i in range(200)]


def test_only_hot_keys_are_written_down(spark, checkpointed):
    r = merge(spark, _hot_and_others(), max_group_rows=10)
    kept = [x["customer_id"] for rows in checkpointed for x in rows]
    assert set(kept) == {"hot"} and len(kept) <= 40  # one row a time
    whole = merge(spark, _hot_and_others())
    assert dim_rows(r) == dim_rows(whole) and len(dim_rows(r)) > 200


def test_other_keys_are_shuffled_once_beside_a_hot_one(spark):
    r = merge(spark, _hot_and_others(), max_group_rows=10)
    r.rows.collect()

    def nodes(n):  # adaptive stages hold their plan aside
        yield n
        c = n.children()
        for k in [n.plan()] if n.nodeName().endswith("QueryStage") else [c.apply(i) for i in range(c.size())]:
            yield from nodes(k)

    final = r.rows._jdf.queryExecution().executedPlan().executedPlan()
    wide = [n.toString() for n in nodes(final) if n.nodeName() == "Exchange"]
    assert sum("REPARTITION_BY_COL" in n.split("\n")[0] for n in wide) == 1
    # every other exchange starts from the hot key's checkpoint
    assert all("REPARTITION_BY_COL" in n.split("\n")[0] or "ExistingRDD" in n for n in wide)


@pytest.mark.parametrize("most", [0, 1, 2])
def test_many_hot_keys_equal_whole(spark, monkeypatch, most):
    """More hot keys than may be broadcast: all keys go through the chunks."""
    import starling.operators.scd2 as scd2

    monkeypatch.setattr(scd2, "MAP_SIDE_KEYS", most)
    test_hot_key_with_state_equals_whole(spark)


def test_hash_of_any_kind_survives_the_shuffle(spark):
    from hashlib import sha256

    from starling.operators.scd2 import shuffled

    hashes = [sha256(b"x").hexdigest(), sha256(b"x").hexdigest().upper(), "abc", "", "zz", "0g", "ab", "AB", "é", " ab", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(hashes)], "k int, h string")
    got = shuffled(df, "h", "k")
    assert got.schema == df.schema and sorted(map(tuple, got.collect())) == list(enumerate(hashes))
    numbers = spark.createDataFrame([(1, 5), (2, None)], "k int, h long")
    assert sorted(map(tuple, shuffled(numbers, "h", "k").collect())) == [(1, 5), (2, None)]


def test_hashes_are_shuffled_as_bytes(spark):
    """Distinct sha-256 hashes: little more than 32 bytes a row are written."""
    from starling.operators.scd2 import shuffled

    n = 20_000
    df = spark.range(n).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"))

    sizes = {}
    for name, out in (("packed", shuffled(df, "h", "id")), ("plain", df.repartition("id"))):
        out.collect()
        final = out._jdf.queryExecution().executedPlan().executedPlan()
        stack, size = [final], None
        while stack:
            node = stack.pop()
            if node.nodeName() == "Exchange":
                size = node.metrics().apply("shuffleBytesWritten").value()
            c = node.children()
            stack += [node.plan()] if node.nodeName().endswith("QueryStage") else [c.apply(i) for i in range(c.size())]
        sizes[name] = size
    assert sizes["packed"] < 0.75 * sizes["plain"], sizes
