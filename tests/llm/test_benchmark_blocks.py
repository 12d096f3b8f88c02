from helpers import prose

from jobstrata.llm import decontaminate


def test_repeated_rows_count_once(spark):
    rows = [(1, prose(20, 1))] * 500 + [(k, prose(20, k)) for k in range(2, 12)]
    bench = spark.createDataFrame(rows, "item_id long, text string")
    held = [b.ids for b in decontaminate.benchmark_blocks(bench, 60)]
    assert sorted(i for ids in held for i in ids) == list(range(1, 12))
