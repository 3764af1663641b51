import threading

from pyspark.sql import functions as F

from helpers import BASE, TARGET, day_rows, feature, features
from tidegate import schemas
from tidegate.operators.features import feature_view
from tidegate.operators.predictions import join_features, join_features_in_buckets, unmatched, unmatched_in_buckets
from tidegate.queries import layout as layout_queries
from tidegate.queries.rows import job_tables
from tidegate.sources import layout
from tidegate.sources.layout import create_bucketed_table, partition_place, replace_bucketed, swap_partitions
from tidegate.sources.shared import fresh_dir
from tidegate.sources.tables import partition_counts, replace_partitions

DAYS = [BASE[0], TARGET]


def bucketed(spark, df, purpose, buckets=4):
    root = fresh_dir(spark, "buckets")
    name = f"{purpose}_{root[-12:]}"
    create_bucketed_table(spark, name, df.schema, "trip_id", buckets, root)
    replace_bucketed(spark, df, name, "trip_id", buckets, DAYS)
    return name


def sides(spark):
    """One key on two dates, one without a partner on its date, one repeated."""
    rows = feature_view(features(spark, [*day_rows(DAYS[0], range(5, 60)), *day_rows(DAYS[1], range(5, 30)), feature("both", DAYS[0], fare_amount=7.0), feature("both", DAYS[1], fare_amount=8.0)]))
    made = rows.select("trip_id", F.lit("m").alias("model_name"), "scoring_date")
    odd = spark.createDataFrame([("alone", "m", DAYS[0]), (f"{DAYS[0]}-3", "m", DAYS[1]), ("both", "m", DAYS[1]), (None, "m", DAYS[1])], made.schema)
    return made.unionByName(odd), rows


def test_bucketed_joins_equal_plain_ones_and_shuffle_nothing(spark):
    made, rows = sides(spark)
    p, f = spark.table(bucketed(spark, made, "p")), spark.table(bucketed(spark, rows, "f"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_features_in_buckets(p, f)
        columns = ["trip_id", "scoring_date", "fare_amount", "model_name"]
        assert sorted(map(tuple, joined.select(*columns).collect())) == sorted(map(tuple, join_features(made, rows).select(*columns).collect()))
        assert sorted(joined.columns) == sorted(join_features(made, rows).columns)
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        left = unmatched_in_buckets(p, f)
        assert sorted(map(tuple, left.collect())) == sorted(map(tuple, unmatched(made, rows).collect())) == [(DAYS[0], 1), (DAYS[1], 2)]
        plan = unmatched_in_buckets(p, f)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # of the counts by date
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rows_of_a_bucketed_table_are_not_shuffled_to_another(spark):
    _, rows = sides(spark)
    f = spark.table(bucketed(spark, rows, "f"))
    plan = f.select("trip_id", "scoring_date").repartition(4, "trip_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_a_bucketed_date_is_replaced_alone(spark):
    _, rows = sides(spark)
    name = bucketed(spark, rows, "f")
    replace_bucketed(spark, rows.where("fare_amount > 20"), name, "trip_id", 4, [DAYS[1]])
    assert partition_counts(spark.table(name), DAYS) == {DAYS[0]: 56, DAYS[1]: 9}


def table_of(spark, rows):
    cfg = job_tables(spark)
    replace_partitions(spark, rows, cfg.features_table, DAYS)
    return cfg.features_table


def test_a_reader_sees_old_or_new_rows(spark):
    many, few = (features(spark, [*day_rows(DAYS[0], range(5, 5 + n)), *day_rows(DAYS[1], range(5, 15))]) for n in (40, 20))
    name = table_of(spark, many)
    planned = spark.table(name).where(F.col("scoring_date") == F.lit(DAYS[0])).select("trip_id")
    assert planned.count() == 40
    seen, failures, over = set(), [], threading.Event()

    def read():
        while not over.is_set():
            try:
                seen.add(partition_counts(spark.table(name), DAYS)[DAYS[0]])
            except Exception as error:
                failures.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for rows in (few, many, few):
            swap_partitions(spark, rows, name, [DAYS[0]])
    finally:
        over.set()
        reader.join()
    assert not failures and seen <= {20, 40} and 20 in seen
    assert partition_counts(spark.table(name), DAYS) == {DAYS[0]: 20, DAYS[1]: 10}


def test_a_swap_may_empty_a_date_add_one_and_be_overwritten(spark):
    name = table_of(spark, features(spark, day_rows(DAYS[0], range(5, 25))))
    assert partition_place(spark, name, DAYS[1]) is None
    found = swap_partitions(spark, features(spark, day_rows(DAYS[1], range(5, 10))), name, DAYS)
    assert found["rows_written"] == 5 and len(found["replaced"]) == 1
    assert partition_counts(spark.table(name), DAYS) == {DAYS[0]: 0, DAYS[1]: 5}
    assert spark.read.parquet(found["replaced"][0]).count() == 20
    replace_partitions(spark, features(spark, day_rows(DAYS[1], range(5, 13))), name, [DAYS[1]])
    assert partition_counts(spark.table(name), DAYS) == {DAYS[0]: 0, DAYS[1]: 8}


def test_a_swap_that_fails_changes_nothing(spark):
    name = table_of(spark, features(spark, day_rows(DAYS[0], range(5, 25))))
    broken = features(spark, day_rows(DAYS[0], range(5, 9))).withColumn("trip_id", F.raise_error(F.lit("no")).cast("string"))
    try:
        swap_partitions(spark, broken, name, [DAYS[0]])
    except Exception as error:
        assert "no" in str(error)
    else:
        raise AssertionError("the write should fail")
    assert partition_counts(spark.table(name), DAYS) == {DAYS[0]: 20, DAYS[1]: 0}


def test_columns_of_the_schema_are_kept(spark):
    name = table_of(spark, features(spark, day_rows(DAYS[0], range(5, 8))))
    swap_partitions(spark, features(spark, day_rows(DAYS[0], range(5, 9))), name, [DAYS[0]])
    assert spark.table(name).columns == schemas.FEATURES.fieldNames()


def test_buckets_of_both_tables_grow_with_the_rows(spark, monkeypatch):
    """A task holds a bucket, which keeps its size: more rows are more buckets, the same for both tables."""
    rows = features(spark, [*day_rows(DAYS[0], range(5, 60)), *day_rows(DAYS[1], range(5, 30)), feature("cash", DAYS[1], payment_type="2")])
    counts, create = [], layout_queries.create_bucketed_table

    def noted(spark, name, schema, key, buckets, root):
        counts.append(buckets)
        create(spark, name, schema, key, buckets, root)

    monkeypatch.setattr(layout_queries, "create_bucketed_table", noted)
    monkeypatch.setattr(layout_queries, "view", lambda *_: feature_view(rows))
    monkeypatch.setattr(layout_queries.star, "trips", lambda *_: rows)
    small = sorted(map(tuple, layout_queries.unmatched_rows_in_buckets(spark, "unused").collect()))
    worth = sorted(map(tuple, layout_queries.expected_value_in_buckets(spark, "unused").collect()))
    monkeypatch.setattr(layout, "BUCKET_ROWS", 5)
    assert sorted(map(tuple, layout_queries.unmatched_rows_in_buckets(spark, "unused").collect())) == small == [(str(DAYS[1]), 1)]
    assert sorted(map(tuple, layout_queries.expected_value_in_buckets(spark, "unused").collect())) == worth
    assert counts == [8, 8, 8, 8, 17, 17, 16, 16]
