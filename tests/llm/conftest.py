import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (id, text) or (id, text, lang, source) tuples; ``extra`` adds columns whose names clash."""
    from pyspark.sql import functions as F

    def build(rows, extra=False):
        full = [(*r, *(None,) * (4 - len(r)), len(r[1]) if r[1] is not None else None) for r in rows]
        table = spark.createDataFrame(full, DOCUMENT).repartition(3)
        if extra:
            for name in ("fingerprint", "component_id", "score", "length", "shard", "slot", "sequence_id", "offset", "size", "key", "_key", "at", "first", "block"):
                table = table.withColumn(name, F.lit("x"))
        return table

    return build


@pytest.fixture(scope="session")
def table_dir(tmp_path_factory):
    """Tables written as parquet files of a folder, as the queries read them."""

    def write(**tables):
        place = tmp_path_factory.mktemp("tables")
        for name, table in tables.items():
            table.write.parquet(str(place / f"{name}.parquet"))
        return str(place)

    return write


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words, the same in every run."""
    import random

    def make(seed, n, vocabulary=4000):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))

    return make
