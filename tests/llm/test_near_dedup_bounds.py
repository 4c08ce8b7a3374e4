"""Near-duplicates: what a task holds does not grow with its batch, and nodes are those of the recursion."""

from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from lodestar.llm import near_dedup as N


def _batches_of(operator, batch):
    """What ``operator`` yields inside a task for one Arrow batch."""
    held = {}
    kind = SimpleNamespace(dataType=SimpleNamespace(simpleString=lambda: "bigint"))
    docs = SimpleNamespace(schema={"doc_id": kind}, mapInArrow=lambda run, ddl: held.setdefault("run", run))
    docs.select = lambda *names: docs
    operator(docs)
    return list(held["run"](iter([batch])))


def test_a_batch_is_sketched_slice_by_slice():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 3000)) for _ in range(300)]
    texts[7], texts[8], texts[9] = None, "", "one two"
    batch = pa.record_batch({"doc_id": pa.array(range(300), pa.int64()), "text": pa.array(texts)})
    join = N.Join(width=4)
    out = _batches_of(lambda d: N.sketches(d, join), batch)
    assert len(out) > 3 and max(len(b) for b in out) < 100
    whole = pa.Table.from_batches(out)
    assert whole["doc_id"].to_pylist() == list(range(300))
    tokens, bounds = N.shingle_sets(batch.column(1), 4)
    assert whole["n_shingles"].to_pylist() == np.diff(bounds).tolist()
    assert whole["n_shingles"].to_pylist()[7:10] == [0, 0, 1]
    assert whole["tokens"].to_pylist() == N.selected_tokens(tokens, bounds, join.functions).tolist()
    assert N.shingle_sets(batch.column(1).slice(0, 0), 4)[1].tolist() == [0]


def _recursion(tokens, join):
    """The final nodes' (members, size, pivot), by the recursion in plain Python."""
    found = []

    def node(ids, tree, level, path):
        for b in range(join.branches[level]):
            child = path * join.branches[level] + b
            at = join.first(level) + join.function(tree, level, child)
            parts = defaultdict(list)
            for i in ids:
                parts[tokens[i][at]].append(i)
            for p in parts.values():
                if len(p) > join.leaf and level + 1 < len(join.branches):
                    node(p, tree, level + 1, child)
                elif len(p) > 1:
                    found.append((tuple(sorted(p)), len(p), min(p)))

    for t in range(join.trees):
        node(sorted(tokens), t, 0, 0)
    return sorted(found)


def test_nodes_are_those_of_the_recursion(spark):
    rng = np.random.default_rng(3)
    # more than 64 places on the deeper levels: their bits take two numbers
    for join in (N.Join(leaf=4), N.Join(trees=20, leaf=3, branches=(2, 2, 1)), N.Join(trees=3, leaf=2, branches=(3, 1, 2))):
        tokens = {i: [int(x) for x in rng.integers(0, 3, join.functions)] for i in range(40)}
        reps = spark.createDataFrame(list(tokens.items()), "id bigint, tokens array<int>")
        rows = N._tree_nodes(reps, join).collect()
        nodes = defaultdict(list)
        for r in rows:
            nodes[r["node"], r["n"], r["pivot"]].append(r["id"])
        assert sorted((tuple(sorted(ids)), n, p) for (_, n, p), ids in nodes.items()) == _recursion(tokens, join)
