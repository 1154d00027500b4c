"""Rows sent to an outside store when tasks and micro-batches are repeated."""

import os
import sys
import tempfile

import pytest
from pyspark import TaskContext, cloudpickle
from pyspark.sql import functions as F

from thermoweave.streaming import batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Store:
    """Puts by key, a file per token; every put is also noted, so that repeats can be seen."""

    def __init__(self, home, breaks=0):
        self.home, self.breaks = home, breaks

    def __call__(self, rows):
        # Fails behind its first row, once in each of the first calls of a task.
        for i, row in enumerate(rows):
            name = row["token"].replace("/", "~")
            with open(f"{self.home}/{name}", "w") as f:
                f.write(f"{row['id']}:{row['seq']}")
            with open(f"{self.home}.puts", "a") as f:
                f.write(f"{name}\n")
            marker = f"{self.home}.broke-{TaskContext.get().partitionId()}"
            if i == 0 and self.breaks and not os.path.exists(marker):
                open(marker, "w").close()
                raise ConnectionError("the store went away")


def held(store):
    return sorted(open(f"{store.home}/{n}").read() for n in os.listdir(store.home))


def shaped(batch):
    """Rows in an order and partitions of their own every time."""
    return batch.select("id", "seq").orderBy(F.rand()).repartition(3)


@pytest.fixture()
def frame(make):
    # Equal rows are rows of their own.
    rows = make([(f"s{i % 3}", i, float(i)) for i in range(30)])
    return rows.withColumn("seq", F.col("seq") % 10).withColumn("id", F.when(F.col("id") != "s2", F.col("id")))


def expected(frame, times=1):
    return sorted(f"{r.id}:{r.seq}" for r in frame.collect() for _ in range(times))


def test_a_failing_and_repeated_micro_batch_leaves_each_row_once(spark, frame):
    state = tempfile.mkdtemp(prefix="send-")
    broken = Store(tempfile.mkdtemp(prefix="store-"), breaks=1)
    write = batches.send_once(spark, shaped, broken, state)
    with pytest.raises(Exception, match="the store went away"):
        write(frame, 0)  # local sessions do not run a task again, so the micro-batch ends
    assert 0 < len(held(broken)) < 30
    for _ in range(5):  # each time the next task fails behind its first row
        try:
            write(frame, 0)
        except Exception as error:
            assert "the store went away" in str(error)
    assert held(broken) == expected(frame)
    puts = open(f"{broken.home}.puts").read().split()
    assert len(puts) > 30 and len(set(puts)) == 30


def test_a_sent_micro_batch_is_not_sent_again_and_old_ones_go(spark, frame):
    state, store = tempfile.mkdtemp(prefix="send-"), Store(tempfile.mkdtemp(prefix="store-"))
    write = batches.send_once(spark, shaped, store, state)
    for k in (0, 1, 1, 2):
        write(frame if k < 2 else frame.limit(0), k)
    assert held(store) == expected(frame, 2)
    assert len(open(f"{store.home}.puts").read().split()) == 60
    assert os.listdir(f"{state}/staged") == ["batch=2"]
    assert [n for n in os.listdir(f"{state}/sent") if not n.startswith(".")] == [f"{2:012d}"]
