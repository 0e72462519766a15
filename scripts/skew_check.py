"""Measure how a hot key is handled: largest shuffle read of any task.

One owner is given a third of all questions (derived from the orders table),
the input is spread over 16 map partitions, and two plans for "per owner:
total and most liked question" run side by side:

* ``aggregate``: the library's form, ``sum`` + ``min(struct(...))`` per owner
  (partial aggregation before the shuffle);
* ``window``: a ``row_number`` window over the owner, the textbook form.

Then one badge name is given a third of all badges (derived from the part
table) and Q6's step "badges whose name was awarded 2..10 times" runs two
ways:

* ``capped_cut``: the library's ``rows_in_groups_sized`` (each name cut to
  11 rows before the shuffle);
* ``join_back``: count per name, then a semi join of all badges against the
  qualifying names, the textbook form.

Then Q3's winner per year (a handful of years, so every group is hot) runs
with Spark's partial ``WindowGroupLimit`` (``group_limit``) and with it
switched off (``no_group_limit``).

Then questions are joined to users with a third of the questions on one owner and a
third without any: the library's ``left_outer`` and ``full_outer`` beside Spark's own, and the
group maximum beside each row (``group_max``), with AQE on and its skew limits at the scale of
this data. For these the median task of the join's stage is reported, too.

The event log (written to a fresh scratch folder) gives, per stage, the
largest number of shuffle records any single task read. Usage:

    python scripts/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def read_events(folder: str):
    import zstandard
    for f in sorted(glob.glob(f"{folder}/*/*")):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="forumlens-eventlog-")
    from pyspark.sql import SparkSession, Window
    from pyspark.sql import functions as F

    spark = (SparkSession.builder.master("local[8]").appName("skew-check")
             .config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.enabled", "false")   # raw partitions, no coalescing
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from forumlens.sources.adapters import questions, read_base

    q = questions(read_base(spark, sf_dir, "orders"))
    hot = F.when(F.col("Id") % 30 == 0, F.lit(0)).otherwise(F.col("OwnerUserId"))
    q = q.withColumn("OwnerUserId", hot).where(F.col("OwnerUserId").isNotNull())
    # 16 input files, so the key shuffle is the only shuffle measured
    q.repartition(16).write.parquet(f"{log_dir}-input")
    q = spark.read.parquet(f"{log_dir}-input")
    total = q.count()
    hot_rows = q.where("OwnerUserId = 0").count()

    spark.sparkContext.setJobDescription("aggregate")
    agg = q.groupBy("OwnerUserId").agg(F.sum("FavoriteCount").alias("t"),
                                       F.max("FavoriteCount").alias("b"))
    agg.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("window")
    w = Window.partitionBy("OwnerUserId").orderBy(F.col("FavoriteCount").desc_nulls_last(), "Id")
    win = q.withColumn("t", F.sum("FavoriteCount").over(Window.partitionBy("OwnerUserId"))) \
        .withColumn("rn", F.row_number().over(w)).where("rn = 1")
    win.write.format("noop").mode("overwrite").save()

    # Q6's step: one badge name holds a third of the gold badges.
    spark.sparkContext.setJobDescription("setup")
    from forumlens.operators.aggregates import having_between, rows_in_groups_sized
    from forumlens.operators.joins import semi_join
    from forumlens.operators.ranking import asc
    from forumlens.sources.adapters import badges
    b = badges(read_base(spark, sf_dir, "part")).withColumn(
        "Name", F.when(F.col("UserId") % 3 == 0, F.lit("hot")).otherwise(F.col("Name")))
    b.select("Name", "UserId").repartition(16).write.parquet(f"{log_dir}-badges")
    gold = spark.read.parquet(f"{log_dir}-badges")
    badge_rows = gold.count()
    hot_badges = gold.where("Name = 'hot'").count()
    # as on a cluster: the qualifying names are too many to broadcast
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.sparkContext.setJobDescription("capped_cut")
    rows_in_groups_sized(gold, ["Name"], 2, 10, [asc("UserId")]) \
        .write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription("join_back")
    semi_join(gold, having_between(gold, ["Name"], 2, 10), [("Name", "Name")]) \
        .write.format("noop").mode("overwrite").save()

    # Q3's step: the winner per year, where every year is a hot group.
    spark.sparkContext.setJobDescription("setup")
    from forumlens.operators.ranking import desc, top_per_group
    from forumlens.plans.questions import up_votes_per_year
    from forumlens.sources.adapters import votes
    votes(read_base(spark, sf_dir, "lineitem")).repartition(16) \
        .write.parquet(f"{log_dir}-votes")
    counts = up_votes_per_year(spark.read.parquet(f"{log_dir}-votes"))
    counts.write.parquet(f"{log_dir}-counts")
    counts = spark.read.parquet(f"{log_dir}-counts")
    count_rows = counts.count()
    winners = top_per_group(counts, ["Year"], [desc("Count")], 1, "first", tiebreak=[asc("PostId")])
    spark.sparkContext.setJobDescription("group_limit")
    winners.write.format("noop").mode("overwrite").save()
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    spark.sparkContext.setJobDescription("no_group_limit")
    winners.write.format("noop").mode("overwrite").save()

    # outer joins: a third of the rows on one key, a third on NULL
    spark.sparkContext.setJobDescription("setup")
    for key, value in (("enabled", "true"), ("skewJoin.enabled", "true"), ("skewJoin.skewedPartitionThresholdInBytes", "64k"),
                       ("skewJoin.skewedPartitionFactor", "1.2"), ("advisoryPartitionSizeInBytes", "64k"),
                       ("coalescePartitions.enabled", "false")):
        spark.conf.set(f"spark.sql.adaptive.{key}", value)
    from forumlens.operators.joins import full_outer, left_outer
    from forumlens.operators.ranking import with_group_max
    from forumlens.sources.adapters import users
    third = F.col("Id") / 10 % 3
    skewed = questions(read_base(spark, sf_dir, "orders")).withColumn("OwnerUserId", F.when(third < 1, F.lit(1)).when(
        third >= 2, F.col("OwnerUserId"))).select("Id", "OwnerUserId", "FavoriteCount")
    skewed.repartition(16).write.parquet(f"{log_dir}-skewed")
    skewed = spark.read.parquet(f"{log_dir}-skewed")
    people = users(read_base(spark, sf_dir, "customer"), read_base(spark, sf_dir, "nation")).select(
        F.col("Id").alias("UserId"), "DisplayName")
    people.repartition(4).write.parquet(f"{log_dir}-people")
    people = spark.read.parquet(f"{log_dir}-people")
    equal = skewed["OwnerUserId"] == people["UserId"]
    outer = {"left_outer": left_outer(skewed, people, [("OwnerUserId", "UserId")]),
             "plain_left_outer": skewed.join(people, equal, "left"),
             "full_outer": full_outer(skewed, people, "OwnerUserId", "UserId"),
             "plain_full_outer": skewed.join(people, equal, "full"),
             "group_max": with_group_max(skewed, ["OwnerUserId"], "FavoriteCount")}
    for name, df in outer.items():
        spark.sparkContext.setJobDescription(name)
        df.write.format("noop").mode("overwrite").save()
    skewed_rows = skewed.count()

    spark.stop()

    stage_job, max_read, reads = {}, {}, {}
    for e in read_events(log_dir):
        ev = e["Event"]
        if ev == "SparkListenerJobStart":
            desc = e.get("Properties", {}).get("spark.job.description")
            for s in e["Stage IDs"]:
                stage_job[s] = desc
        elif ev == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            desc = stage_job.get(e["Stage ID"])
            if desc in ("aggregate", "window", "capped_cut", "join_back", "group_limit",
                        "no_group_limit"):
                read = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                max_read[desc] = max(max_read.get(desc, 0), read)
            elif desc in outer:
                read = e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"]
                if read:
                    reads.setdefault(desc, {}).setdefault(e["Stage ID"], []).append(read)
    joins = {}
    for name, stages in reads.items():
        busiest = max(stages.values(), key=sum)      # the stage that reads the questions
        joins[name] = {"largest": max(busiest), "median": sorted(busiest)[len(busiest) // 2], "tasks": len(busiest)}
    report = {"outer_join_rows": skewed_rows, "records_read_by_tasks_of_outer_joins": joins, "questions": total, "hot_owner_rows": hot_rows, "map_tasks": 16,
              "badges": badge_rows, "hot_badge_rows": hot_badges,
              "post_year_counts": count_rows,
              "max_shuffle_records_read_by_one_task": max_read}
    print(json.dumps(report))


if __name__ == "__main__":
    main()
