"""Near-duplicates and worker memory: checkpoints have files by rows, workers give freed memory back."""

import glob
import os
import random
from types import SimpleNamespace

import pyarrow as pa

from lodestar.llm import kernel as K
from lodestar.llm import near_dedup as N


def test_checkpoints_have_files_by_their_rows_not_by_shuffle_partitions(spark):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(40)]
    texts += [t + " tail" for t in texts[:20]] + texts[:10]
    texts += [" ".join(["same"] * k + texts[0].split()) for k in range(1, 40)]  # one crowded node
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    changed = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir").removeprefix("file://")
    before, old = set(glob.glob(f"{folder}/*/rdd-*")), {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        got = {r["doc_id"]: r["component_id"] for r in N.near_duplicates(docs, N.Join(leaf=4)).collect()}
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert all(got[40 + i] == got[60 + i] == i for i in range(10)) and all(got[40 + i] == i for i in range(20))
    files = sorted(len([p for p in os.listdir(d) if p.startswith("part-")]) for d in set(glob.glob(f"{folder}/*/rdd-*")) - before)
    assert len(files) > 8
    assert files[-2] <= 8, files  # but for the one table of all links


def test_a_partition_gives_its_freed_memory_back(monkeypatch):
    given = []
    monkeypatch.setattr(K, "give_back", lambda: given.append(1))
    kind = SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))
    held = {}
    docs = SimpleNamespace(schema={"doc_id": kind}, mapInArrow=lambda run, ddl: held.setdefault("run", run))
    docs.select = lambda *names: docs
    N.sketches(docs, N.Join())
    batch = pa.record_batch({"doc_id": pa.array([1, 2]), "text": pa.array(["a b c d e f", None])})
    out = held["run"](iter([batch, batch]))
    assert sum(len(b) for b in out) == 4
    assert given == [1]


def test_memory_is_given_back_to_the_system():
    K.give_back()
