"""The methods against brute force, exact round trips and held-out accuracy, on small inputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lodestar.llm import chat_format, decontaminate, language_id, license_scan, near_dedup, packing, quality_rules, resampling, sharding, token_counts
from lodestar.llm import kernel as K
from lodestar.llm import tokenize as T

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts(n=120, seed=3):
    """Random texts with copies, near copies, repeated lines, accents and junk."""
    r = random.Random(seed)
    words = ["alpha", "Beta", "gäma", "delta", "ε", "中文", "zeta,", "eta.", "*th*", "io", "ka", "la"]
    out = []
    for i in range(n):
        if out and r.random() < 0.4:
            base = WORDS.findall(r.choice(out)) or ["x"]
            for _ in range(r.choice([0, 1, 1, 2, 9])):
                base[r.randrange(len(base))] = r.choice(words) + str(i)
            out.append(" ".join(base))
        else:
            lines = [" ".join(r.choice(words) + str(r.randrange(40)) for _ in range(r.randrange(1, 12))) for _ in range(r.randrange(1, 9))]
            out.append("\n".join(lines + lines[:r.randrange(3)]))
    return out


def test_words_and_hashes():
    data = ["", "a b", None, "  ", "\x0bé\xa0x  y\n", "b a" * 3]
    for _, _, offs, raw in K.text_slices(pa.array(data), budget=4):
        start, end, first = K.word_bounds(raw, offs)
        whole = raw.tobytes()
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            own = whole[offs[i]:offs[i + 1]].decode()
            assert [whole[s:e].decode() for s, e in zip(start[a:b], end[a:b], strict=True)] == WORDS.findall(own)
        h = K.word_hashes(raw, start, end)
        named = [whole[s:e] for s, e in zip(start, end, strict=True)]
        assert len(set(zip(named, h.tolist(), strict=True))) == len(set(named)) == len(set(h.tolist()))


def test_quality_counts_brute_force():
    data = [*texts(), "", None, "a\na\n a\n\n", "x y z w v x y z w v q"]
    got = quality_rules.count_texts(pa.array(data))
    for i, t in enumerate(data):
        words = WORDS.findall(t or "")
        grams = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
        often = Counter(grams)
        covered = {j for k, g in enumerate(grams) if often[g] > 1 for j in range(k, k + 5)}
        lines, dup = set(), 0
        for line in (t or "").split("\n"):
            if WORDS.search(line):
                dup += line in lines
                lines.add(line)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(covered))
        assert want == tuple(int(got[c][i]) for c in quality_rules.COUNTS[:5])


def test_votes_recover_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    votes = np.stack([np.where(rng.random(20_000) < 0.1, 0, np.where(good, np.where(rng.random(20_000) < 0.97, 1, -1),
                     np.where(rng.random(20_000) < 0.7, -1, 1))) for _ in quality_rules.RULES], 1)
    model = quality_rules.fit_votes([(*k, n) for k, n in Counter(map(tuple, votes.tolist())).items()])
    assert abs(model.prior - 0.8) < 0.02
    assert all(abs(p - 0.97) < 0.02 for p in model.good_right) and all(abs(p - 0.7) < 0.04 for p in model.bad_right)


def test_near_dedup_brute_force(spark):
    data = texts(200, 5)
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id bigint, text string")
    join = near_dedup.Join(width=4, leaf=4)
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(docs, join).collect()}
    sets = []
    for t in data:
        w = WORDS.findall(t.translate(ASCII_LOWER))
        sets.append({tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    parent = list(range(len(data)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(data)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    assert [(len(sets[i]), root(i), root(i) == i) for i in range(len(data))] == [
        (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) for i in range(len(data))]
    assert len({root(i) for i in range(len(data))}) < 190


def test_near_dedup_joins_an_id_with_its_tokens_once(spark, monkeypatch):
    """One large group of near copies stands in every tree: its rows per tree and path are not joined one by one."""
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join([*words, f"end{i}"])) for i in range(40)], "doc_id bigint, text string")
    frame, met = type(docs), []

    def joined(self, other, on=None, how=None, f=frame.join):
        if isinstance(on, str) and on == "id" and "tokens" in other.columns:
            met.append(self.count() - self.select("id").distinct().count())
        return f(self, other, on, how)

    monkeypatch.setattr(frame, "join", joined)
    got = near_dedup.near_duplicates(docs, near_dedup.Join(width=4, leaf=4)).collect()
    assert met and set(met) == {0}
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


def _linked_classes(sets, percent=80):
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(i) for i in range(len(sets))]


def test_near_dedup_crowded_nodes(spark, monkeypatch):
    """Large nodes of documents around 0.8 to each other: chains, several classes, single documents."""
    monkeypatch.setattr(near_dedup, "PIVOTS", 3)
    monkeypatch.setattr(near_dedup, "BLOCK", 400)
    rng = random.Random(3)
    sets = []
    for i in range(260):
        core = [f"core{k}" for k in range(60)]
        own = [f"group{i % 7}x{k}" for k in range(rng.choice([0, 12, 14, 30]))] + [f"own{i}x{k}" for k in range(rng.randrange(16))]
        sets.append(set(core + own))
    docs = spark.createDataFrame([(i, " ".join(sorted(x))) for i, x in enumerate(sets)], "doc_id bigint, text string")
    join = near_dedup.Join(width=1, leaf=8)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs.repartition(3), join).collect()}
    want = _linked_classes(sets)
    assert [got[i] for i in range(len(sets))] == want and len(set(want)) > 3


def test_block_links_span():
    """Of a block only links that join components come back, on full sets."""
    sets = [[1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [1, 2, 3, 4], [7, 8], [7, 8], [9]]
    rows = pa.table({"id": [10, 11, 12, 13, 14, 15], "component": [10, 11, 10, 13, 14, 15], "left": [False, True, False, True, False, True],
                     "members": pa.array(sets, pa.list_(pa.int64()))})
    assert near_dedup._spanning(rows, 80).to_pylist() == [{"a": 11, "b": 10}, {"a": 13, "b": 14}]


def test_near_dedup_recall_where_every_level_is_used(spark):
    pairs, rows = 600, []
    for i in range(pairs):  # 40 words in common, 5 of their own: similarity 0.8
        common = [f"c{i}x{k}" for k in range(40)]
        rows += [(2 * i + j, " ".join(common + [f"o{i}x{j}x{k}" for k in range(5)])) for j in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")

    def found(trees):
        join = near_dedup.Join(width=1, trees=trees, leaf=1)  # every node of two is branched
        return near_dedup.near_duplicates(docs, join).where("not kept").count() / pairs, join.recall(0.8)

    share, said = found(1)
    assert abs(share - said) < 0.07
    assert found(8)[0] == 1 and 1 - near_dedup.Join().recall(0.8) < 3e-7


def test_near_dedup_filter_rejects_no_link(spark):
    one = "struct({n}L as n_shingles, array({t}) as tokens, array_repeat({p}L, 16) as parity) as {c}"
    tokens = [",".join([str(k)] * near_dedup.Join().functions) for k in (1, 2)]
    for n, p, may in ((100, 0, True), (80, 0, True), (79, 0, False), (100, -1, False)):  # no equal token
        row = spark.range(1).selectExpr(one.format(n=100, t=tokens[0], p=0, c="x"), one.format(n=n, t=tokens[1], p=p, c="y"))
        assert row.where(near_dedup._may_link("x", "y", near_dedup.Join())).count() == may


def test_packing_keeps_large_ids_beside_a_null(spark):
    """A null id in a group of the residue leaves the others as they are."""
    ids = [2 ** 60 + i for i in (1, 2, 3)] + [None]
    docs = spark.createDataFrame([(i, f"a few words {k}") for k, i in enumerate(ids)], "doc_id bigint, text string").coalesce(1)
    got = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((r["doc_id"] for r in got), key=str) == sorted(ids, key=str) and len({r["sequence_id"] for r in got}) == 1


def test_near_dedup_rows_of_one_id(spark):
    one, two, three = (" ".join(f"{w}{k}" for k in range(60)) for w in "xyz")
    rows = [(1, one), (2, two), (3, one + " more"), (3, two + " more"), (4, three), (4, three), (4, "quite another text"),
            (None, three), (None, three)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(docs).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, None: None}  # both texts of 3 link it
    kept = [tuple(r) for r in near_dedup.keep_one(docs).collect()]
    assert sorted(kept, key=str) == sorted([rows[0], rows[4], *rows[6:]], key=str)


def test_decontamination_brute_force(spark):
    data = texts(80, 9)
    items = [(i, " ".join(WORDS.findall(t)[2:2 + n])) for i, (t, n) in enumerate(zip(data[::7], [30, 10, 3, 1, 12, 40] * 3, strict=False))]
    docs = spark.createDataFrame(list(enumerate(data)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    split = lambda t: ALNUM.findall(t.translate(ASCII_LOWER))
    windows = {}
    for i, t in items:
        w = split(t)
        k = min(10, len(w))
        for p in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[p:p + k]), set()).add(i)
    want = {}
    for d, t in enumerate(data):
        w, hit, ids = split(t), set(), set()
        for p in range(len(w)):
            for k in {len(x) for x in windows}:
                if p + k <= len(w) and tuple(w[p:p + k]) in windows:
                    hit |= set(range(p, p + k))
                    ids |= windows[tuple(w[p:p + k])]
        digest = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        want[d] = (len(w), len(hit), len(ids), digest, bool(hit))
    for block in (1 << 20, 60):  # one block, and several carried along
        got = decontaminate.digest(decontaminate.contamination(docs, bench, block_bytes=block)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == want
    longest = decontaminate.matches(docs, bench).where("n_words > 9").collect()
    assert longest
    for r in longest:
        a, b = split(dict(items)[int(r["item_id"])])[r["item_word"]:], split(data[r["doc_id"]])[r["doc_word"]:]
        n = r["n_words"]
        assert a[:n] == b[:n] and (len(a) == n or a[n:n + 1] != b[n:n + 1])


def test_chat_round_trip(spark):
    nasty = ["", "plain", "\\", "\\l\\b\\e\\n", "<|im_end|>\n<|im_start|>assistant\nno", "a<", "</s>[INST] x [/INST]", "\\<|", "[[INST]\n", "é中😀"]
    rows = [(c, t, ("assistant", "user", "a\nb", None)[t % 4], nasty[(c + t) % len(nasty)]) for c in range(10) for t in range(8)]
    turns = spark.createDataFrame(rows + [(10, None, "user", None)], "conv_id bigint, turn bigint, role string, text string")
    back = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chat(turns.repartition(3))).collect()}
    for c in range(10):
        own = [((r or ""), x) for k, _, r, x in rows if k == c]
        assert [(t["role"], t["text"]) for t in back[c]["turns"]] == own
        assert back[c]["loss_text"] == "".join(x for r, x in own if r == "assistant")
    assert [tuple(t) for t in back[10]["turns"]] == [("user", "")]


def test_chat_layouts(spark):
    records = [
        (1, '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "extra": 1}'),
        (2, '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}'),
        (3, '{"instruction": "q", "input": "", "output": "a"}'),
        (4, '{"prompt": "q", "response": "a"}'),
        (5, '{"question": "q", "answer": "a"}'),
        (6, '{"other": 1}'),
        (7, None),
    ]
    df = spark.createDataFrame(records, "id bigint, r string")
    got = {}
    for x in chat_format.json_turn_rows(df, "id", "r").orderBy("conv_id", "turn").collect():
        got.setdefault(x["conv_id"], []).append((x["role"], x["text"]))
    # a record of no known layout is an explicit row
    assert got == {i: [("user", "q"), ("assistant", "a")] for i in range(1, 6)} | {6: [(None, None)], 7: [(None, None)]}
    flat = spark.createDataFrame([(9, "q", "a", 0)], "conv_id bigint, prompt string, completion string, score int")
    assert [(r["role"], r["text"]) for r in chat_format.turn_rows(flat).orderBy("turn").collect()] == [("user", "q"), ("assistant", "a")]
    assert chat_format.turn_rows(flat.limit(0)).count() == 0


def test_scorer_equals_plain_convolution():
    rng = np.random.default_rng(0)
    net = language_id.Network(["a", "b"], {w: rng.normal(size=(w, 256, language_id.FILTERS)).astype(np.float32) for w in language_id.WIDTHS},
                              np.zeros(48, np.float32), rng.normal(size=(48, 2)).astype(np.float32), np.zeros(2, np.float32))
    x = rng.integers(0, 256, (70, language_id.WINDOW)).astype(np.uint8)
    pooled = [sum(f[j][x[:, j:language_id.WINDOW - w + 1 + j]] for j in range(w)).max(1) for w, f in net.filters.items()]
    want = np.maximum(np.concatenate(pooled, 1), 0) @ net.dense
    assert np.allclose(language_id.Scorer(net).logits(x), want, atol=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language_id.predict(docs, language_id.fit(docs)).select("row.doc_id", "row.lang", "lang_pred")
    held = found.where(language_id.held_out())
    assert held.where("lang = lang_pred").count() >= 0.95 * held.count()


def test_token_counts_brute_force():
    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    machine, known, longest = token_counts.Automaton(pieces), set(pieces), max(map(len, pieces))
    for _, _, offs, data in K.text_slices(pa.array([*texts(60), "é" * 150, "a" * 400, ""])):
        start, end, _ = K.word_bounds(data, offs)
        raw, want = data.tobytes(), []
        for s, e in zip(start, end, strict=True):
            w, n = token_counts.MARK + raw[s:e], 0
            while w:
                w = w[next(k for k in range(min(longest, len(w)), 0, -1) if w[:k] in known):]
                n += 1
            want.append(n)
        assert machine.lengths(data, start, end).tolist() == want


def test_chunk_tokens_equal_whole_texts():
    import tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, cut = tokenizers.Tokenizer.from_file(path), T.Chunks(path)
    for t in [*texts(60), "Don't 'tis ÉTÉ ÇA İstanbul ΑΣ x's a.b, <|endoftext|> \x1c q\x0bz ｆｕｌｌ 😀 ,,;; é́"]:
        assert np.frombuffer(cut.ids(t.encode()), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


def test_packing_is_tight():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 2049, 3000)
    sequence, offset = packing.best_fit(lengths, 2048)
    for s in range(sequence.max() + 1):
        own = np.flatnonzero(sequence == s)
        at = offset[own].argsort()
        assert offset[own][at].tolist() == [0, *np.cumsum(lengths[own][at])[:-1].tolist()]
    histogram = np.bincount(-(-lengths // 8), minlength=257)[1:]
    used, times = packing.pattern_counts(histogram, 3)
    spent = np.bincount(used[used > 0], np.repeat(times, (used > 0).sum(1)), 257)[1:]
    assert (spent <= histogram).all() and (used.sum(1) == 256).all()
    left = np.repeat(np.arange(1, 257) * 8, (histogram - spent).astype(int))
    total = times.sum() + (packing.best_fit(left, 2048)[0].max(initial=-1) + 1)
    assert total <= 1.03 * lengths.sum() / 2048 + 1


def test_ring_moves_few(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before = {r["doc_id"]: r["shard"] for r in sharding.ring_shards(docs, 10, slack=0.1).collect()}
    after = {r["doc_id"]: r["shard"] for r in sharding.ring_shards(docs, 11, slack=0.1).collect()}
    assert max(Counter(before.values()).values()) <= 2201
    assert sum(before[d] != after[d] for d in before) < 0.3 * len(before)


def test_resampling_prefers_targets(spark):
    rows = [(i, ("good clean prose here " if i % 4 == 0 else "spam junk offer now ") * (3 + i % 5)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    targets = docs.where("doc_id % 8 = 0").select("doc_id")
    got = resampling.resample(docs, targets, share=0.25)
    assert got.where("selected").count() == 100 and got.where("selected and doc_id % 4 = 0").count() >= 95
    keys = sorted((r["key"] for r in got.collect()), reverse=True)
    for k in (1, 7, 100, 400):
        assert resampling.kth_largest(got, "key", k) == keys[k - 1]


def test_licence_notices_with_one_more_word(spark):
    rows = [
        ("licensed under the CC BY 4.0", "cc-by-4.0", 0.8),
        ("released under the permissive MIT license", "mit", 0.75),
        ("licensed under CC BY-NC 4.0", "cc-by-nc-4.0", 1.0),  # not cc-by-4.0 with one more word
        ("licensed under CC BY 4.0", "cc-by-4.0", 1.0),
        ("the MIT license, the MIT license", "", 0.5),  # grams that come twice count once
        ("MIT licensed code", "", 0.0),
        # the run of diagonals is longer than the notice may be
        ("by 4 x " * 9 + "licensed under CC BY 4.0" + " x by 4" * 9, "cc-by-4.0", 1.0),
    ]
    docs = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(docs, phrases=()).collect()}
    assert [got[i] for i in range(len(rows))] == [r[1:] for r in rows]
    based = {r["doc_id"]: r["base_labels"] for r in license_scan.scan(docs).collect()}
    assert based == {0: "cc-by", 1: "mit", 2: "cc-by", 3: "cc-by", 4: "mit", 5: "", 6: "cc-by"}


def test_many_contaminated_words_in_one_shard():
    """Linear in the hits: every text repeats benchmark passages; hits and items as a plain scan finds them."""
    import time

    rng = random.Random(4)
    items = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(300))) for i in range(200)]
    block = decontaminate.Suffixes(items, 10)
    documents = [" ".join(items[rng.randrange(200)][1] for _ in range(4)) + f" own{k}" for k in range(50)]
    began = time.perf_counter()
    counts, hit, first, named = decontaminate.shard_hits([d.encode() for d in documents], block)
    assert time.perf_counter() - began < 4 and counts.sum() == 50 * 1201 and hit.sum() == 50 * 1200
    for k, d in enumerate(documents[:5]):
        assert {block.ids[i] for i in named[k]} == {str(i) for i, t in items if t in d}


def test_long_words_are_counted_like_short_steps():
    """Pieces of a long word that start in the wrong state are stepped again; repeated bytes never settle."""
    machine = token_counts.Automaton([b"ab", b"abc", b"cab", b"aaaaaaa", b"ca", b"bcab", *(bytes([x]) for x in range(256))])
    rng = random.Random(1)
    for text in ("".join(rng.choices("abc", k=20_000)), "a" * 9_999, "abc" * 3_000, "x", "cab" * 100, "a" * 5_000 + "".join(rng.choices("abc", k=9_000))):
        data = np.frombuffer(text.encode(), np.uint8)
        for start in (0, int(machine.step(np.zeros(1, np.int32), np.zeros(1, np.int64), np.array([97], np.uint8))[0])):
            state, total = start, 0
            for c in data.tolist():
                while (z := int(machine.next[machine.row[state], c])) < 0:
                    total, state = total + int(machine.popped[state]), int(machine.fail[state])
                state = z
            assert machine._long(data, start) == (state, total)


def test_records_of_every_layout_keep_their_turns(spark):
    import json

    records = [
        {"instruction": "do", "output": "done"}, {"instruction": "do", "input": "this", "output": "done", "system": "be brief"},
        {"prompt": "p", "response": "r", "system": "s"}, {"prompt": "p", "completion": "c", "system": ""}, {"messages": []},
        {"messages": [{"role": "user"}, {"role": "assistant", "content": "late"}]}, {"messages": [{"content": "no role"}]},
        {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}, {"conversations": []},
        {"unknown": 1}, {"question": "q", "answer": "a", "tags": ["x", "y"]}, [1, 2], {"messages": [{"role": "user", "content": "x", "id": 3}]}]
    rows = [(i, json.dumps(r)) for i, r in enumerate(records)] + [(50, None), (51, "no json")]
    got = {}
    for r in chat_format.json_turn_rows(spark.createDataFrame(rows, "id bigint, r string"), "id", "r").orderBy("conv_id", "turn").collect():
        got.setdefault(r["conv_id"], []).append((r["layout"], r["role"], r["text"]))
    said = {k: [x[1:] for x in v] for k, v in got.items()}
    assert set(got) == {r[0] for r in rows}
    assert said[0] == [("user", "do"), ("assistant", "done")]
    assert said[1] == [("system", "be brief"), ("user", "do\nthis"), ("assistant", "done")]
    assert said[2] == [("system", "s"), ("user", "p"), ("assistant", "r")] and said[3] == [("user", "p"), ("assistant", "c")]
    assert got[4] == [("no messages", None, None)] and got[8] == [("no exchanges", None, None)]
    assert said[5] == [("user", None), ("assistant", "late")] and said[6] == [(None, "no role")]
    assert said[7] == [("user", "a"), ("assistant", "b")] and said[10] == [("user", "q"), ("assistant", "a")] and said[12] == [("user", "x")]
    assert all(got[k] == [(None, None, None)] for k in (9, 11, 50, 51))


def test_weights_and_draw_against_plain_counts(spark):
    """Log weights from plain counts of hashed grams; equal keys at the cut are taken by key order, never more than asked."""
    words = ["good", "fine", "bad", "poor", "text", "more"]
    rng = random.Random(3)
    data = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 12)))) for i in range(120)] + [(200, None)]
    docs = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    good = docs.where("doc_id % 4 = 0").select("doc_id")
    a = {r["doc_id"]: r for r in resampling.resample(docs, good, share=0.25).collect()}
    b = {r["doc_id"]: r for r in resampling.resample(docs.repartition(7), good, share=0.25).collect()}
    assert {k: (round(v["log_weight"], 6), v["selected"]) for k, v in a.items()} == {
        k: (round(v["log_weight"], 6), v["selected"]) for k, v in b.items()}
    assert sum(r["selected"] for r in a.values()) == round(0.25 * 121) or abs(sum(r["selected"] for r in a.values()) - 0.25 * 121) <= 1
    # texts of the same words in the same order weigh the same
    same = {}
    for i, t in data:
        same.setdefault(t or "", set()).add(round(a[i]["log_weight"], 9))
    assert all(len(v) == 1 for v in same.values())


def test_components_against_union_find(spark):
    from lodestar.llm.components import components

    rng = random.Random(7)
    chain = [(i, i + 1) for i in range(100, 160)]
    edges = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + chain + [(5, 5), (3, 4), (3, 4), (4, 3)]
    links = [{a, b} for a, b in edges]
    want = {}
    for x in sorted({v for e in edges for v in e}):
        if x in want:
            continue
        todo = [x]
        while todo:
            y = todo.pop()
            if y not in want:
                want[y] = x
                todo += [z for e in links if y in e for z in e]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(4)).collect()}
    assert {k: v for k, v in got.items()} == {k: v for k, v in want.items() if k in got}
    alone = {a for a, b in edges if a == b and not any(a in e and len(e) == 2 for e in links)}
    assert set(want) - set(got) == alone  # an id linked to itself only is in no link
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
