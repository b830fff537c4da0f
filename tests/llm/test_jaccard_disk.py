"""What the Jaccard join leaves on disk, and which entries it shuffles."""

import os
import random
import re
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quartermart.llm import jaccard as J
from quartermart.llm.common import bitmap_of, in_bitmap, write_table


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def tables(spark):
    home = re.sub("^file:", "", spark.sparkContext.getCheckpointDir())
    return {n.rpartition("-")[0] if re.search("-[0-9a-f]{32}$", n) else n for n in os.listdir(home)}


def texts(n=60, words=80):
    r = random.Random(5)
    rows = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(words))) for i in range(n)]
    return rows + [(n + i, t if i % 3 else t + " more") for i, (_, t) in enumerate(rows[:9])]


def test_a_written_table_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = write_table(rows, "disk")
    bitmap_of(spark.range(1000).select(F.xxhash64("id").alias("key")), "key", 16)
    for _ in range(100):  # Spark doesn't wait until they are gone
        left = {n for n in shuffle_files(spark) - before if n.endswith(".data")}
        time.sleep(0.1 if left else 0)
    assert not left and table.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) in (None, "false")


def test_tables_that_nothing_reads_any_more_are_gone(spark):
    kept = tables(spark)
    J.near_groups(spark.createDataFrame(texts(), "doc_id long, text string")).collect()
    assert not (tables(spark) - kept) & {"jaccard-met", "jaccard-pairs", "jaccard-hidden", "jaccard-large", "jaccard-rest", "jaccard-links"}


def test_only_keys_of_two_sets_are_written(spark, monkeypatch):
    """Sixty texts, six of which have a near copy: few entries are left of the unrelated ones, and none of a copy is lost."""
    written, repartition = [], spark.range(0).__class__.repartition

    def counted(self, *to):
        if to == ("key",):
            written.append(self.count())
        return repartition(self, *to)

    monkeypatch.setattr(spark.range(0).__class__, "repartition", counted)
    found = {r.doc_id: r.component_id for r in J.near_groups(spark.createDataFrame(texts(), "doc_id long, text string")).collect()}
    assert found == {i: i if i < 60 else i - 60 for i in range(69)}
    near = 3 * 2 * (76 // 4 + 3)  # three texts with one word more, and the texts they are copies of
    assert len(written) == 1 and 0 < written[0] <= near + 5


def test_lists_of_keys():
    r = np.random.default_rng(3)
    tasks = [r.integers(0, 1 << 48, n, dtype=np.uint64) for n in (1, 2, 5000, 700)]
    tasks[2][10:14] = tasks[2][9]
    tasks[3][:50] = tasks[2][100:150]
    batches = [J._lists(t) for t in tasks]
    rows = pa.Table.from_batches(batches)
    bitmap = np.zeros((1 << J.RANGE_BITS, 1 << (J.KEY_BITS - J.RANGE_BITS - 3)), np.uint8)
    for at in set(rows.column("at").to_pylist()):
        own = J._twice(rows.filter(pa.compute.equal(rows.column("at"), at)))
        bitmap[own.column("block")[0].as_py()] = np.frombuffer(own.column("bits")[0].as_py(), np.uint8)
    every, n = np.unique(np.concatenate(tasks), return_counts=True)
    told = in_bitmap(bitmap.ravel(), J.KEY_BITS, J.mix(every))
    assert told[n > 1].all() and told.sum() <= (n > 1).sum() + 2 and (n > 1).sum() == 51


def test_classes_that_fill_up_by_chance_are_not_frequent(monkeypatch):
    monkeypatch.setattr(J, "CLASS_BITS", 10)
    r = random.Random(2)
    phrase = "one phrase that many texts have"
    rows = [" ".join(f"u{r.randrange(10**9)}" for _ in range(200)) + (f" {phrase}" if i % 2 else "") for i in range(400)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(400), pa.int64()), "text": rows, "print": pa.array(range(400), pa.int64())})
    *_, classes = J._nodes(iter([batch]))
    found = classes.column("class").to_pylist()
    assert 2 <= len(found) <= 6 and all(150 < n < 260 for n in classes.column("entries").to_pylist())


def test_rows_of_one_set(spark):
    """Of rows with equal sets one is indexed, whatever their ids."""
    rows = J._first_rows(spark.createDataFrame([(None, 5, 3, 1), (2, 5, 3, 1), (3, 6, 3, 2), (4, 7, 0, 0)], "doc_id long, print long, n int, node long"))
    hashed = spark.sql("select xxhash64(cast(null as bigint), 5L) a, xxhash64(2L, 5L) b, xxhash64(3L, 6L) c, xxhash64(4L, 7L) d").first()
    texts = pa.RecordBatch.from_pydict({"text": ["a", "b", "c", "d"], "row": pa.array(list(hashed), pa.int64())})
    (left,) = J._indexed(iter([texts]), SimpleNamespace(value=rows.value))
    assert len(left) == 2 and "c" in left.column("text").to_pylist()
