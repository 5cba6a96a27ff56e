from lavra.llm.common import small_batches

KEYS = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"


def test_texts_are_read_and_handed_over_in_small_batches(spark):
    """Neither the Parquet reader nor Arrow takes thousands of whole texts at once; smaller settings stay."""
    before = {k: spark.conf.get(k, None) for k in KEYS}
    try:
        for k in KEYS:
            spark.conf.unset(k)
        small_batches(spark)
        assert [int(spark.conf.get(k)) for k in KEYS] == [1000, 128]
        for k in KEYS:
            spark.conf.set(k, "50")
        small_batches(spark)
        assert [int(spark.conf.get(k)) for k in KEYS] == [50, 50]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
