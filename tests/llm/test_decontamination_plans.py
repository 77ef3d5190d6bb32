"""What the driver holds of decontamination: small plans, whatever the benchmark's size."""

import random

from pyspark.sql import functions as F

from bookpipe.llm import decontaminate


def benchmark_of(spark, items: int):
    rng = random.Random(items)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(30))) for i in range(items)]
    return spark.createDataFrame(rows, "item_id bigint, text string"), rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_do_not_grow_with_the_benchmark(spark):
    docs = spark.createDataFrame([(1, "a text of some words and no item")], "doc_id bigint, text string")
    sizes = []
    for n in (5, 300):
        shingles = decontaminate.item_shingles(decontaminate.items_of(benchmark_of(spark, n)[0]), 5)
        assert decontaminate.bit_table(shingles).words >= n * 26
        sizes.append(len(plan(decontaminate.hits(docs, shingles, 5))))
    assert max(sizes) < 20_000 and max(sizes) < 1.1 * min(sizes)


def test_the_last_plan_holds_no_earlier_step(spark):
    benchmark, rows = benchmark_of(spark, 3)
    docs = spark.createDataFrame([(10, "before " + rows[0][1]), (11, "nothing of it")], "doc_id bigint, text string")
    last = plan(decontaminate.leaks(docs, benchmark))
    assert "bit_count" not in last and "regexp_extract_all(lower(coalesce(text" in last and len(last) < 30_000
    clean = decontaminate.clean(docs, benchmark)
    assert "bit_count" not in plan(clean) and plan(clean).count("Join") == 1
    assert [r.doc_id for r in clean.collect()] == [11]


def test_bits_hold_all_shingles_and_few_others(spark):
    shingles = decontaminate.item_shingles(decontaminate.items_of(benchmark_of(spark, 40)[0]), 5)
    table = decontaminate.bit_table(shingles)
    own = [r.h for r in shingles.collect()]
    others = [r.h for r in spark.range(20_000).select(F.xxhash64(F.col("id") + 10**9).alias("h")).collect()]
    rows = spark.createDataFrame([([(h, i) for i, h in enumerate(x)],) for x in (own, others, [])], "_s array<struct<h: bigint, at: int>>")
    some = rows.select(table.row.scalar().alias("_bits"), "_s").select("_s", table.among(F.col("_bits"), F.col("_s")).alias("kept"))
    for r in some.collect():
        want = {h for h, _ in r["_s"]} & set(own)
        assert want <= {h for h, _ in r["kept"]} and len(r["kept"]) <= len(r["_s"]) * (1 if want else 0.001)
    assert {len(r["_s"]) for r in some.collect()} == {len(own), len(others), 0}
