import pytest


@pytest.fixture(scope="session")
def make(spark):
    """A documents table with columns whose names clash with the operators'
    own (``digest``, ``raw``, ``node``, ``n``, ``score``), doc_id nullable."""
    def build(rows, partitions=3):
        ddl = ("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, digest STRING, "
               "raw STRING, node BIGINT, n BIGINT, score DOUBLE, host STRING, kept BOOLEAN, row BIGINT")
        full = [(i, t, (x[0] if x else "en"), "s", None, "d", "r", 1, 2, 0.5, "h", False, 9)
                for i, t, *x in rows]
        return spark.createDataFrame(full, ddl).repartition(partitions)
    return build


# Null, empty, white space, ties, repeats and a long text: every operator gets these.
def awkward():
    long = " ".join(f"w{k % 977}x{k % 1009}" for k in range(60_000))
    return [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three"), (5, "one two three"),
            (6, "one  two\tthree"), (7, long), (8, long), (None, "no id at all"), (9, "été 你好 \U0001f600"),
            (10, "x\x00y \x1c z\x85w"), (-3, "one two three")]
